"""One query for each operator, over its whole table, and DuckDB SQL where it can say the same."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm import (
    fim, hilbert, html_text, jaccard, knn, line_dedup, mixing, packing, pfor, quality_classifier, quality_rules,
    toxicity, vector_codes,
)
from ledgerline.llm.ship import ship
from ledgerline.llm.tables import unsigned_remainder
from ledgerline.llm.tokens import REMEMBERED_ALONE
from ledgerline.operators.cuts import cut, scratch_root

Query = Callable[[SparkSession, str], DataFrame]
QUALITY_FOLDS, QUALITY_HELD_OUT = 5, 0
TOXIC_FOLDS, TOXIC_HELD_OUT = 3, 1


def _shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out(folds: int, held_out: int):
    return F.coalesce(unsigned_remainder("doc_id", folds) == held_out, F.lit(False))


def quality_labels(labels: DataFrame) -> DataFrame:
    """Quality labels outside the held-out fold."""
    seen = labels.where(~_held_out(QUALITY_FOLDS, QUALITY_HELD_OUT))
    return seen.select("doc_id", F.col("quality").alias("label"))


def toxic_labels(labels: DataFrame) -> DataFrame:
    """Toxicity labels outside the held-out fold."""
    seen = labels.where(~_held_out(TOXIC_FOLDS, TOXIC_HELD_OUT))
    return seen.select("doc_id", F.col("toxic").alias("label"))


def op1_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_root(spark)}/token-blocks-{uuid.uuid4().hex}"
    pfor.write_tokens(_table(spark, sf_dir, "documents"), path)
    return pfor.read_tokens(spark, path, with_ids=False)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    statistics = cut(quality_classifier.text_statistics(documents), "statistics")
    model = quality_classifier.fit(statistics, quality_labels(_table(spark, sf_dir, "labels")))
    scored = quality_classifier.score_statistics(statistics, model)
    held_out = _held_out(QUALITY_FOLDS, QUALITY_HELD_OUT).alias("held_out")
    return scored.select("doc_id", held_out, "score", "predicted")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = _table(spark, sf_dir, "labels").where("quality = 1")
    ratios = quality_rules.log_ratios(documents, trusted)
    return quality_rules.judge(documents, ratios).drop("text")


def op4_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.top_k(_table(spark, sf_dir, "embeddings"), F.expr("vec_id % 50 = 0"), 5)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, remembered=REMEMBERED_ALONE)


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(_table(spark, sf_dir, "pages"))


def op7_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.hilbert_shards(_table(spark, sf_dir, "documents"), 16).drop("curve")


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mix(_table(spark, sf_dir, "documents"))
    target = F.round("target", 6).alias("target")
    return taken.select("doc_id", "size", "source_size", target, "taken")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(documents, toxic_labels(_table(spark, sf_dir, "labels")))
    held_out = _held_out(TOXIC_FOLDS, TOXIC_HELD_OUT).alias("held_out")
    scored = toxicity.score_documents(documents, model)
    return scored.select("doc_id", held_out, "score", "predicted")


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return fim.fill_in_middle(documents).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restored(), 256).alias("restored_sha256"),
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    codes, codebooks = vector_codes.vector_codes(vectors)
    summed = vector_codes.with_label_errors(cut(codes, "codes"))
    digest = F.lit(vector_codes.codebooks_sha256(codebooks))
    return summed.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.dedup_lines(documents)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES: dict[str, Query] = {
    q.__name__: _shipped(q)
    for q in (
        op1_token_blocks,
        op2_quality_classifier,
        op3_quality_rules,
        op4_voronoi_knn,
        op5_best_fit_packing,
        op6_html_text,
        op7_hilbert_shards,
        op8_source_mix,
        op9_toxicity,
        op10_ngram_jaccard,
        op11_fill_in_middle,
        op12_vector_codes,
        op13_line_dedup,
    )
}

_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _codes_sql(rounds: int = 4) -> str:
    """Every round as tables: all parts with their nearest entry, and the entries after it."""
    steps = [
        """whole as (
            select vec_id, label, row_number() over (order by vec_id) as place,
                list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v
            from embeddings
            where embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ),
        parts as (
            select place, vec_id, label, p, v[p * len(v) // 4 + 1 : (p + 1) * len(v) // 4] as x
            from whole, range(4) t(p)
        ),
        book0 as materialized (select p, place - 1 as e, x from parts where place <= 256)"""
    ]
    for k in range(rounds + 1):
        steps.append(
            f"""near{k} as materialized (
            select place, parts.p, any_value(parts.x) as x, min(struct_pack(
                d := list_sum(list_transform(list_zip(parts.x, b.x),
                    lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint,
                e := b.e)) as found
            from parts join book{k} b on b.p = parts.p group by place, parts.p
        )"""
        )
        if k < rounds:
            steps.append(
                f"""book{k + 1} as materialized (
            select b.p, b.e, coalesce(m.x, b.x) as x
            from book{k} b left join (
                select p, e, list((s - (s % n + n) % n) // n order by i) as x from (
                    select p, found.e as e, i, sum(x[i])::bigint as s, count(*) as n
                    from near{k}, range(1, 1 + (select max(len(x)) from parts)) t(i) group by all
                ) group by all
            ) m on b.p = m.p and b.e = m.e
        )"""
            )
    return f"""
        with {", ".join(steps)},
        coded as (
            select place, string_agg(printf('%02x', found.e), '' order by p) as code,
                sum(found.d)::bigint as error
            from near{rounds} group by place
        )
        select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
            (select sha256(string_agg(array_to_string(x, ','), ',' order by p, e)) from book{rounds})
                as codebooks_sha256
        from coded join whole using (place)
    """


ORACLE_SQL: dict[str, str] = {
    "op12_vector_codes": _codes_sql(),
    "op4_voronoi_knn": """
        with whole as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v
            from embeddings
            where vec_id is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ),
        scored as (
            select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
            from whole q join whole c on q.vec_id != c.vec_id
            where q.vec_id % 50 = 0
        )
        select query_id, cast(row_number() over w as int) as rank, vec_id, score
        from scored
        window w as (partition by query_id order by score desc, vec_id)
        qualify row_number() over w <= 5
    """,
    "op8_source_mix": f"""
        with docs as (
            select doc_id, source, len({_WORDS.format("text")}) as size,
                md5(concat_ws(':', doc_id, text)) as hash
            from documents
        ),
        sources as (
            select source, sum(size)::bigint as source_size, 3.0 * sum(size) as cap,
                1 + (row_number() over (order by source nulls last) - 1) % 3 as weight
            from docs group by source
        ),
        levels as (
            select *, (
                (select sum(source_size) from sources)
                - coalesce((select sum(b.cap) from sources b where b.cap / b.weight < a.cap / a.weight), 0)
            ) / (select sum(b.weight) from sources b where b.cap / b.weight >= a.cap / a.weight) as level
            from sources a
        ),
        plan as (
            select source, source_size,
                least(cap, weight * (select max(level) from levels where cap >= level * weight)) as target
            from levels
        ),
        laid as (
            select *, (sum(size) over (
                partition by source order by hash, size, doc_id rows unbounded preceding
            ) - size)::bigint as place
            from docs
        ),
        quotas as (select *, floor(target + 0.5)::bigint as words from plan)
        select doc_id, size, source_size, round(target, 6) as target,
            case when source_size = 0 then 0 else words // source_size * size
                + greatest(least(words % source_size - place, size), 0) end::bigint as taken
        from laid join quotas on laid.source is not distinct from quotas.source
    """,
    "op11_fill_in_middle": """
        with hashed as (
            select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n,
                sha256('1:' || coalesce(doc_id::varchar, '')) as digits
            from documents
        ),
        drawn as (
            select *, list_transform([0, 1, 2, 3],
                lambda k: ('0x' || substring(digits, 8 * k + 1, 8))::bigint) as h
            from hashed
        ),
        cuts as (
            select *, least(h[1] % (n + 1), h[2] % (n + 1)) as a,
                greatest(h[1] % (n + 1), h[2] % (n + 1)) as b,
                case when n = 0 or contains(text, '<P>') or contains(text, '<S>')
                        or contains(text, '<M>') or h[3] % 100 >= 90 then 'plain'
                    when h[4] % 100 < 20 then 'spm' else 'psm' end as form
            from drawn
        ),
        parts as (
            select *, substring(text, 1, a) as prefix, substring(text, a + 1, b - a) as middle,
                substring(text, b + 1) as suffix
            from cuts
        )
        select doc_id, n::bigint as n, form,
            case when form != 'plain' then a end::bigint as prefix_chars,
            case when form != 'plain' then b - a end::bigint as middle_chars,
            sha256(case form when 'plain' then text
                when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
            sha256(text) as restored_sha256
        from parts
    """,
    "op13_line_dedup": f"""
        with lines as (
            select doc_id, unnest(l) as line, generate_subscripts(l, 1) as pos
            from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents)
        ),
        keyed as (
            select *, trim(translate(line, '{_UPPER}', '{_LOWER}'), ' ' || chr(9) || chr(10) || chr(11)
                || chr(12) || chr(13)) as key
            from lines
        ),
        often as (
            select key, max(doc_id) as keeper from keyed where length(key) >= 20
            group by key having count(distinct doc_id) >= 3
        ),
        marked as (
            select keyed.*, coalesce(doc_id != keeper, false) as gone
            from keyed left join often on keyed.key = often.key
        )
        select doc_id, count(*)::bigint as n_lines, count(*) filter (gone)::bigint as n_dropped,
            sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
        from marked group by doc_id
    """,
    "op10_ngram_jaccard": f"""
        with recursive worded as (
            select doc_id, {_WORDS.format(f"translate(text, '{_UPPER}', '{_LOWER}')")} as w
            from documents
        ),
        sets as (
            select doc_id, case
                when len(w) = 0 then []
                when len(w) < 4 then [array_to_string(w, ' ')]
                else list_distinct(list_transform(
                    generate_series(1, len(w) - 3), lambda i: array_to_string(w[i:i + 3], ' ')))
            end as s
            from worded
        ),
        shingles as (select doc_id, len(s) as n, unnest(s) as shingle from sets),
        links as (
            select a.doc_id as a, b.doc_id as b
            from shingles a join shingles b on a.shingle = b.shingle and a.doc_id != b.doc_id
            group by a.doc_id, b.doc_id, a.n, b.n
            having 100 * count(*) >= 85 * (a.n + b.n - count(*))
        ),
        reach(doc_id, other) as (
            select doc_id, doc_id from documents
            union
            select reach.doc_id, links.b from reach join links on links.a = reach.other
        )
        select sets.doc_id, len(s)::bigint as n_shingles, min(other) as component_id
        from sets join reach using (doc_id)
        group by sets.doc_id, s
    """,
}
