"""Small tables with the cases that every operator defines a result for."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, score string, kept int"


def documents(n: int = 60, seed: int = 3) -> list[tuple]:
    """Ordinary texts, then NULLs, empty, white and very long texts, ties and repeated rows, in
    a table with extra columns named like outputs."""
    rng = random.Random(seed)
    parts = "the of tion ing er an re on at en nd sh".split()
    texts: list[str | None] = [
        " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(rng.randint(20, 200)))
        for _ in range(n)
    ]
    long = " ".join("".join(rng.choices(parts, k=3)) for _ in range(30_000))
    changed = texts[0].replace(" ", "\t", 3).upper()
    texts += [None, "", " \n\t ", "one", "one two", "ONE two", "Ünïcödé ß 日本 🙂 it's", long, texts[0], changed]
    rows = [
        (k, t, "en" if k % 3 else None, f"src{k % 4}" if k % 5 else None, len(t or ""), "x", 7)
        for k, t in enumerate(texts)
    ]
    return [*rows, rows[5], rows[5], (None, texts[1], "en", "src1", None, None, None)]


def words(text: str | None) -> list[str]:
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
