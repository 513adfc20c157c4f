"""Ids of words against the tokenizers library, also where hashes of words meet."""

import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))

from odd import DOCUMENTS, documents, words  # noqa: E402

from ledgerline.llm import jaccard, packing, pfor, quality_rules, tokens  # noqa: E402
from ledgerline.llm.arrow import text_bytes  # noqa: E402
from ledgerline.llm.words import Words, same_blocks  # noqa: E402


def thue_morse(letters: int, pair: str = "ab") -> str:
    return "".join(pair[k.bit_count() % 2] for k in range(letters))


PATTERNS = [thue_morse(n, pair) for n in (512, 1024, 2048, 4096) for pair in ("ab", "ba")]


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokens.vocabulary_path())
    return lambda text: model.encode(text or "", add_special_tokens=False).ids


def encoded(encoder: tokens.Encoder, texts: list) -> list[list[int]]:
    ids, bounds = encoder.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def test_patterns_of_letters_have_hashes_of_their_own():
    rng = np.random.default_rng(1)
    texts = [*PATTERNS, *("a" * n for n in range(1, 70)), *("\0" * n for n in range(1, 20))]
    texts += ["ab" * n for n in range(1, 70)] + ["".join(rng.choice(list("ab"), 40)) for _ in range(200)]
    texts = list(dict.fromkeys(texts))
    data, bounds = text_bytes(pa.array(texts))
    found = Words(data, bounds)
    assert len(set(found.hash.tolist())) == len(texts) == len(found.hash)
    every = np.arange(len(texts))
    assert found.same(every, every).all() and not found.same(every, np.roll(every, 1)).any()
    left, right = words("x aa abcdefgh abcdefghi"), words("aa x abcdefgi abcdefghj")
    assert len(left) == len(right)


def test_same_blocks():
    data, bounds = text_bytes(pa.array(["abcdefghij abcdefgh abcdefghik abcdefghij abcdefgh\0"]))
    w = Words(data, bounds)
    pairs = [(0, 3, True), (0, 2, False), (0, 1, False), (1, 4, False), (1, 1, True)]
    a, b = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
    found = same_blocks(w.blocks, w.first_block[a], w.length[a], w.blocks, w.first_block[b], w.length[b])
    assert found.tolist() == [p[2] for p in pairs]


@pytest.mark.parametrize("remembered", [300, 500_000])
def test_ids_are_those_of_whole_texts(whole, remembered):
    texts = [row[1] for row in documents()] + PATTERNS + [" ".join(PATTERNS), None, ""]
    encoder = tokens.Encoder(tokens.vocabulary_path(), remembered)
    for _ in range(2):
        assert encoded(encoder, texts) == [whole(t) for t in texts]
        for k in range(0, len(texts), 7):
            assert encoded(encoder, texts[k : k + 7]) == [whole(t) for t in texts[k : k + 7]]


def test_common_words_are_learned_once_beside_many_rare_ones(whole, monkeypatch):
    learned: list[int] = []
    learn = tokens.Encoder._learn
    monkeypatch.setattr(tokens.Encoder, "_learn", lambda self, words, data, which: (
        learned.append(len(which)), learn(self, words, data, which))[1])
    encoder = tokens.Encoder(tokens.vocabulary_path(), 300)
    common = " ".join(f"common{k}x" for k in range(100))
    texts = [f"{common} " + " ".join(f"rare{k}y{j}" for j in range(50)) for k in range(40)]
    for text in texts:
        assert encoded(encoder, [text]) == [whole(text)]
        assert len(encoder.old.keys) + len(encoder.new.keys) <= 300
    assert sum(learned) == 100 + 40 * 50
    marked = ["Été,", "naïve!?", "ÿß.", "×", "÷a", "a×b", "Ünder;:", "a.b", "..", "a\u0301", "İ", "ſ", "K", "a\0"]
    assert encoded(encoder, marked) == [whole(text) for text in marked]


def test_a_word_is_learned_once_in_any_case_and_before_marks(whole, monkeypatch):
    learned: list[int] = []
    learn = tokens.Encoder._learn
    monkeypatch.setattr(tokens.Encoder, "_learn", lambda self, words, data, which: (
        learned.append(len(which)), learn(self, words, data, which))[1])
    encoder = tokens.Encoder(tokens.vocabulary_path())
    stems = [a + b for a in ("wyrd", "été", "naß", "zq") for b in ("am", "bel", "cor")]
    texts = [" ".join(s + mark for s in stems) for mark in ("", ",", ".###", "!?")]
    texts += [" ".join(s.title() for s in stems), " ".join(s.upper() for s in stems if s.isascii())]
    for text in texts:
        assert encoded(encoder, [text]) == [whole(text)]
    assert sum(learned) == len(stems) + 3 + 3  # the marks, and été with a capital É


def test_units_keep_what_the_tokenizer_sees_as_one(whole):
    texts = [
        "<|endoftext|>", "a<|endoftext|>B,<|startoftext|>", "x<|EndOfText|>y", "<|ENDOFTEXT|>", "<|endoftext| >", "|endoftext|",
        "H\u0331 h\u0331 aH\u0331,", "e\u0301, E\u0301.", "I\u0307!", "a\u0338= a=\u0338", "don't I'LL x''s ?'s O'S.", "a×, a÷. ÿ, é× ß;",
        "K, \u212a, \u212b. ſ;", "日, a日b. €, A€", "A", ",", "É", "a.B.c,D", "x_Y-z@W", "9a, a9. A9B,",
    ]
    encoder = tokens.Encoder(tokens.vocabulary_path())
    for many in (texts, texts[::-1], [" ".join(texts)], *([t] for t in texts)):
        assert encoded(encoder, many) == [whole(t) for t in many]


def test_words_of_one_hash_keep_their_ids(whole, monkeypatch):
    monkeypatch.setattr(Words, "_hashes", lambda self: (self.length % 3).astype(np.uint64))
    encoder = tokens.Encoder(tokens.vocabulary_path())
    for texts in (["one two three four", "six"], ["three one seven", "two two ten"], [row[1] for row in documents()[:5]]):
        assert encoded(encoder, texts) == [whole(t) for t in texts]


def test_patterns_in_the_operators(spark, tmp_path, whole):
    rows = [(k, text, "en", "s", 1, "x", 7) for k, text in enumerate(PATTERNS)]
    rows.append((100, " ".join(PATTERNS), "en", "s", 1, "x", 7))
    docs = spark.createDataFrame(rows, DOCUMENTS)
    pfor.write_tokens(docs, str(tmp_path / "tokens"))
    read = {r["doc_id"]: r["ids"] for r in pfor.read_tokens(spark, str(tmp_path / "tokens")).collect()}
    assert {k: v[:-1] for k, v in read.items()} == {r[0]: whole(r[1]) for r in rows}
    pieces = packing.cut_pieces(docs, with_ids=True).orderBy("doc_id", "piece").collect()
    joined: dict = {}
    for r in pieces:
        joined.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u2").tolist())
    assert {k: v[:-1] for k, v in joined.items()} == {r[0]: whole(r[1]) for r in rows}
    alone = jaccard.jaccard_components(docs).collect()
    assert all(r["component_id"] == r["doc_id"] for r in alone)
    a, b = PATTERNS[4:6]
    text = " ".join([a, "x", "y", b, "x", "y"] + [f"w{k}" for k in range(60)])
    counted = spark.createDataFrame([(1, text)], "doc_id long, text string")
    ratios = quality_rules.log_ratios(counted, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert quality_rules.judge(counted, ratios).first()["n_repeat_words"] == 0
