"""Small tables with every awkward row: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, bucket int, first string, h long"


def awkward(spark, seed: int = 1, rows: int = 40):
    """(DataFrame, [(doc_id, text)]): invented words, copies, near copies, shared passages and the odd rows."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    passage = " ".join(rng.choice(words) for _ in range(30))
    texts: list[tuple[int | None, str | None]] = []
    for i in range(rows):
        body = [rng.choice(words) for _ in range(rng.randint(1, 120))]
        text = " ".join(body)
        if i % 4 == 1 and texts and texts[-1][1]:
            text = texts[-1][1]  # an exact copy
        elif i % 4 == 2 and texts and texts[-1][1]:
            near = texts[-1][1].split()
            near[len(near) // 2] = "changed"
            text = " ".join(near)
        elif i % 4 == 3:
            text = f"{text}\n{passage}\n{text[:40]}"
        texts.append((i * 3, text))
    texts += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "One"), (1004, "x " * 4000), (1005, "é" * 70), (1006, "\0\x01 \x7f"),
              (None, "no id at all"), (None, None), texts[3], texts[3], (2, passage), (1007, passage.upper())]
    langs, sources = ["en", "de", None], ["b", "a", None, "c"]
    full = [(d, t, langs[i % 3], sources[i % 4], len(t or ""), 0.5, 1, "x", 7) for i, (d, t) in enumerate(texts)]
    return spark.createDataFrame(full, SCHEMA), texts


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
