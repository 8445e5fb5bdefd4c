from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from snapmart.llm import quality as Q
from tests.llm.spark_fixture import EDGE_ROWS, docs_of, with_clashing_columns


def brute(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(zip(words, words[1:], words[2:]))
    inside = [False] * len(words)
    for i in range(len(words) - 2):
        if seen[tuple(words[i : i + 3])] > 1:
            inside[i] = inside[i + 1] = inside[i + 2] = True
    n = sum(inside)
    good = [x for x in lines if brute_line(x)]
    size, left = sum(map(len, lines)), sum(map(len, good))
    failed = len(words) < 50 or 100 * n > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), n, failed, not failed and 2 * left >= size)


def brute_line(line: str) -> bool:
    words = re.findall(r"[^\x20\x09-\x0D]+", line)
    ends = re.search(Q.END_MARK, line)
    return bool(words and ends and not re.search(Q.NAV_MARKS, line) and not re.search(Q.BOILERPLATE, line))


def got(df) -> list[tuple]:
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return sorted((tuple(r) for r in Q.quality(df).select(*names).collect()), key=str)


def random_rows() -> list[tuple]:
    rnd = random.Random(11)
    pieces = ["a", "b", "c", "d", "e.", "f!", "| x |", "All Rights Reserved.", "\n", "\n\n", "é", "\x0b", "\U0001f600", "#", "$5", "  ", "\t", "\x1f", " "]
    rows = [(i, " ".join(rnd.choices(pieces, k=rnd.randrange(160))), "s") for i in range(120)]
    rows += [(200 + i, "\n".join(" ".join(rnd.choices([f"w{j}" for j in range(60)], k=12)) + rnd.choice([".", "", "?"]) for _ in range(9)), "s") for i in range(40)]
    return rows


@pytest.mark.parametrize("rows", [random_rows(), EDGE_ROWS], ids=["random", "edges"])
def test_against_brute_force(spark, rows):
    df = with_clashing_columns(docs_of(spark, rows))
    assert got(df) == sorted(((i, *brute(t)) for i, t, _ in rows), key=str)


def test_clean_keeps_good_lines(spark):
    good = " ".join(f"word{i}" for i in range(60)) + "."
    rows = [(1, f"Home\n{good}\nprivacy policy and cookies.\nA | B | C.\nEnd.", "s"), (2, "Home\n" * 60, "s"), (3, None, "s")]
    assert [tuple(r) for r in Q.clean(docs_of(spark, rows)).collect()] == [(1, f"{good}\nEnd.")]
    assert Q.clean(docs_of(spark, rows).limit(0)).collect() == []


def test_plan_is_native_without_shuffle(spark):
    plan = Q.quality(docs_of(spark, EDGE_ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
