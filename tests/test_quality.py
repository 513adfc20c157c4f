import pytest

from conftest import TESTDATA, frame
from ledgerline.operators import cuts
from ledgerline.plans import staging as st, transactions as tr
from ledgerline.quality import checks as ch, runner, suite
from ledgerline.quality.runner import Check
from ledgerline.sources.bridge import bridge


@pytest.fixture
def pets(spark):
    rows = [
        {"id": 1, "kind": "cat", "n": 1, "owner": "a"}, {"id": 2, "kind": "dog", "n": 0, "owner": "b"},
        {"id": 2, "kind": "dgo", "n": -1, "owner": "x"}, {"id": None, "kind": None, "n": None},
        {"id": None, "kind": "dgo", "n": 9, "owner": "x"},
    ]
    return frame(spark, "id int, kind string, n int, owner string", rows)


@pytest.fixture
def owners(spark):
    return frame(spark, "name string, active int", [{"name": "a", "active": 1}, {"name": "b", "active": 0}])


def test_each_check_finds_its_failures(pets, owners):
    assert [tuple(r) for r in ch.unique(pets, "id").collect()] == [(2, 2)]
    assert ch.not_null(pets, "id").count() == 2
    assert ch.not_null(pets, "id", where="n > 5").count() == 1
    assert [tuple(r) for r in ch.accepted_values(pets, "kind", ["cat", "dog"]).collect()] == [("dgo", 2)]
    assert ch.accepted_range(pets, "n", 0, 5).count() == 2
    assert ch.accepted_range(pets, "n", 0, inclusive=False).count() == 2
    assert ch.expression_is_true(pets, "> 0", "n").count() == 2
    assert ch.expression_is_true(pets, "id + n > 2").count() == 3
    assert ch.relationships(pets, "owner", owners, "name").count() == 2
    assert ch.relationships(pets, "owner", owners, "name", parent_where="active = 1").count() == 3
    assert ch.equal_rowcount(pets, owners).first().difference == 3
    assert ch.equal_rowcount(pets, pets).count() == 0


def test_sequence_is_daily(spark):
    rows = [{"k": "A", "d": d} for d in ("2024-01-01", "2024-01-02", "2024-01-02", "2024-01-04")]
    rows += [{"k": "B", "d": "2024-01-09"}]
    found = ch.sequence_is_daily(frame(spark, "k string, d date", rows), "k", "d").collect()
    assert sorted((r.k, str(r.d), str(r.previous_d)) for r in found) == [
        ("A", "2024-01-02", "2024-01-02"), ("A", "2024-01-04", "2024-01-02")
    ]


def test_runner_counts_like_the_checks_and_sets_status(pets, owners):
    listed = [
        Check("pets", "unique", "id"),
        Check("pets", "unique", "owner", warn_above=0, error_above=1),
        Check("pets", "not_null", "id", where="n > 5", error_above=1),
        Check("pets", "not_null", "id", severity="warn"),
        Check("pets", "accepted_values", "kind", {"values": ["cat", "dog"]}),
        Check("pets", "accepted_range", "n", {"min_value": -5, "max_value": 9}),
        Check("pets", "expression_is_true", "n", {"expression": "> 0"}),
        Check("pets", "relationships", "owner", {"parent": "owners", "field": "name"}),
        Check("pets", "equal_rowcount", arguments={"other": "owners"}),
        Check("owners", "not_null", "name"),
    ]
    results = {
        (r.check, r.severity): (r.failures, r.status)
        for r in runner.run_checks(listed, {"pets": pets, "owners": owners}).collect()
    }
    expected = [
        (1, "fail"), (1, "warn"), (1, "warn"), (2, "warn"), (1, "fail"), (0, "pass"), (2, "fail"),
        (2, "fail"), (3, "fail"), (0, "pass"),
    ]
    assert results == {(c.name, c.severity): e for c, e in zip(listed, expected)}


def test_a_table_is_scanned_once_under_all_its_names(pets, owners):
    """For conditions, values and its number of rows, whatever a second name adds."""
    pets, owners = cuts.cut(pets, "pets"), cuts.cut(owners, "owners")
    each = [
        ("unique", "id", {}, 1), ("not_null", "id", {}, 2), ("expression_is_true", "n", {"expression": "> 0"}, 2),
        ("accepted_values", "kind", {"values": ["cat", "dog"]}, 1),
        ("relationships", "owner", {"parent": "owners", "field": "name"}, 2),
        ("equal_rowcount", None, {"other": "owners"}, 3), ("equal_rowcount", None, {"other": "animals"}, 0),
    ]
    listed = [Check(t, k, c, a) for t in ("pets", "animals") for k, c, a, _ in each]
    found = runner.run_checks(listed, {"pets": pets, "animals": pets, "owners": owners})
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2
    assert "binary)" in found._jdf.queryExecution().optimizedPlan().toString()  # no small table of keys before
    counts = {(r.table, r.check): r.failures for r in found.collect()}
    assert counts == {(c.table, c.name): n for c, (*_, n) in zip(listed, each * 2)}


def test_more_conditions_than_bits_of_a_number(spark):
    rows = spark.range(100).selectExpr("id", "nullif(id, 7) AS n")
    listed = [Check("rows", "expression_is_true", "n", {"expression": f">= {i}"}) for i in range(70)]
    listed += [Check("rows", "not_null", "n"), Check("rows", "equal_rowcount", arguments={"other": "none"})]
    found = runner.run_checks(listed, {"rows": rows, "none": rows.where("id < 0")}).collect()
    counts = {r.check: r.failures for r in found}
    expected = [i - (i > 7) for i in range(70)] + [1, 100]
    assert counts == {c.name: n for c, n in zip(listed, expected)}


def test_the_suite_writes_no_row_that_only_checks_read(spark, monkeypatch):
    """Neither the dense mart nor, for their numbers, the converted rows a second time."""
    written = []

    def wrapped(df, name, *rest, original=cuts.cut):
        written.append(name)
        return original(df, name, *rest)

    for module in (suite, tr, suite.mo):
        monkeypatch.setattr(module, "cut", wrapped)
    inputs = bridge(spark, TESTDATA)
    dates = spark.sql("SELECT explode(sequence(date'1995-01-01', date'2003-12-31')) AS date_day").selectExpr(
        "date_day", "trunc(date_day, 'month') month_start_date", "last_day(date_day) month_end_date"
    )
    tables = suite.all_tables(inputs, dates)
    assert {"converted", "contract-spend", "revenue", "monthly-activity"} <= set(written)
    assert not {"monthly", "converted-rows"} & set(written)
    assert tables["converted"].columns == tr.CONVERTED
    clients = st.stage_transactions(inputs.transactions).select("client_id").distinct().count()
    months = tables["monthly"].groupBy("month_start_date").count()
    assert months.where(f"count != {clients}").isEmpty() and not months.isEmpty()


def test_stored_failures_can_be_read_back(spark, pets, tmp_path):
    listed = [Check("pets", "unique", "id", store_failures=True), Check("pets", "not_null", "id")]
    for _ in range(2):  # a second run replaces the first
        paths = runner.store_failures(listed, {"pets": pets}, str(tmp_path))
    assert len(paths) == 1
    assert [tuple(r) for r in spark.read.parquet(*paths.values()).collect()] == [(2, 2)]


def test_failing_rows_of_all_checks_are_stored_by_run(spark, pets, tmp_path):
    listed = [
        Check("pets", "unique", "id"), Check("pets", "not_null", "id"),
        Check("pets", "expression_is_true", "id", {"expression": "< 3"}),
    ]
    for run in ("1", "2", "2"):  # a run is replaced
        paths = runner.store_rows(listed, {"pets": pets}, str(tmp_path), run)
    back = spark.read.parquet(paths["pets"])
    assert set(pets.columns) | {"check", "check_id", "run"} == set(back.columns)
    by_check = {(r["run"], r["check"]): r["count"] for r in back.groupBy("run", "check").count().collect()}
    twice = pets.groupBy("id").count().where("count > 1 and id is not null").agg({"count": "sum"}).first()[0]
    expected = {"unique id": twice, "not_null id": pets.where("id is null").count(),
                listed[2].name: pets.where("id >= 3").count()}
    assert by_check == {(run, name): n for run in (1, 2) for name, n in expected.items() if n}


def test_suite_size():
    listed = [
        *suite.rule_checks(), *suite.staging_checks(), *suite.step_checks(), *suite.mart_checks()
    ]
    assert [len(part) for part in (
        suite.rule_checks(), suite.staging_checks(), suite.step_checks(), suite.mart_checks())
    ] == [10, 49, 39, 28]
    assert len({(c.table, c.name, c.severity) for c in listed}) == 126


def test_planted_errors_are_found(spark):
    patterns = {"client_pattern": "^C[0-9]{12}$", "transaction_pattern": "^T[0-9]{12}$"}
    clean, dirty = (
        {
            (r.table, r.check): r.failures
            for r in runner.run_checks(
                suite.staging_checks(**patterns), suite.staged_tables(bridge(spark, TESTDATA, broken))
            ).collect()
        }
        for broken in (False, True)
    )
    found = {name for name, failures in dirty.items() if failures > clean[name]}
    assert {column for table, column in [(t, c.split()[1]) for t, c in found] if table == "transactions"} == {
        "transaction_id", "client_id", "transaction_amount", "transaction_type",
        "transaction_currency", "linked_transaction_id",
    }
    assert {c.split()[1] for t, c in found if t == "resolutions"} == {"transaction_id", "resolution_date"}
    repeats = next(n for (t, c), n in clean.items() if c == "unique linked_transaction_id")
    assert repeats == 30
