from __future__ import annotations

import hashlib
import random
import re

import numpy as np

from snapmart.llm import pii
from tests.llm.spark_fixture import EDGE_ROWS, docs_of, with_clashing_columns

#: The four base patterns as stated, applied naively.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def naive(text: str | None) -> list[tuple[int, int, int]]:
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 14 <= len(digits) <= 19
                and sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(digits[::-1])) % 10 == 0,
                "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]()
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def spans_text(spans) -> str:
    return ",".join(f"{list(PATTERNS)[k]}:{s}:{e}" for s, k, e in spans)


def test_base_patterns_on_random_text():
    rnd = random.Random(3)
    pieces = ["a@b.co", "a@b", "@", ".", "1.2.3.4", "300.1.1.1", "+1 (212) 555-0100", "4111 1111 1111 1111", "4111111111111111", "12", "-", " ", "x", "+", "é", "5", "(", "007.8.9.10", "\n", "%", "4111-1111-1111-1112"]
    for _ in range(3000):
        text = "".join(rnd.choices(pieces, k=rnd.randrange(12)))
        got = sorted((s, pii.KINDS.index(k), e) for k, s, e, ok in pii.base_matches(text) if ok)
        assert got == naive(text), text


def test_driver_documents(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = pii.find_spans(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = naive(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(spans_text(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        every = [s for s in r.spans.split(",") if s]
        assert set(spans_text(base).split(",")) - {""} <= set(every) and len(every) == len(base) + r.n_added


def test_edge_rows(spark):
    docs = with_clashing_columns(docs_of(spark, [*EDGE_ROWS, (8, "mail a.b@c.org\nor +1 (212) 555-0100 é 10.0.0.1", "x")]))
    rows = {(r.doc_id, r.spans) for r in pii.find_spans(docs).collect()}
    assert (8, "email:5:14,phone:18:35,ip:38:46") in rows
    assert pii.find_spans(docs.limit(0)).collect() == []
    masked = {r.doc_id: r for r in pii.mask(docs).collect()}
    assert masked[8].text == "mail <email>\nor <phone> é <ip>" and masked[8].n_chars == len(masked[8].text)
    assert masked[2].text is None and pii.mask(docs).columns == docs.columns


def test_long_runs_are_linear():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1" + " " * 200_000, "a@" * 100_000):
        pii.candidates(text)


def test_em_recovers_reliabilities():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.3
    right = np.array([0.95, 0.8, 0.7, 0.9])
    votes = np.where(rng.random((20_000, 4)) < right, np.where(truth, 1, -1)[:, None], np.where(truth, -1, 1)[:, None])
    combos, counts = np.unique(votes, axis=0, return_counts=True)
    prior, tables, _ = pii.reliabilities(combos, counts.astype(float))
    assert abs(prior - 0.3) < 0.03
    assert np.abs(tables[1, :, 2] - right).max() < 0.05


def test_loose_phone_is_added_where_labelers_agree(spark):
    rows = [(i, f"please call +1 (212) 555-{i:04d} today", "s") for i in range(200)]
    rows += [(200 + i, f"please call 212 555 {i:04d} today", "s") for i in range(40)]
    rows += [(300 + i, f"version x{i}1-22-33-{i:04d}y of it", "s") for i in range(200)]
    got = {r.doc_id: r.n_added for r in pii.find_spans(docs_of(spark, rows)).collect()}
    assert all(got[i] == 0 for i in range(300, 500))
    assert all(got[i] == 0 for i in range(200))


def test_loose_spans_are_added_where_base_spans_are_common(spark):
    rows = [(i, f"please call +1 (212) 555-{i:04d} today", "s") for i in range(200)]
    rows += [(200 + i, f"please call 212 555 {i:04d} today", "s") for i in range(40)]
    rows += [(300 + i, f"host 10.0.0.{i} is up", "s") for i in range(100)]
    rows += [(400 + i, f"host 2001:db8:0:0:0:0:0:{i:x} is up", "s") for i in range(20)]
    # Numbers that nothing speaks for, or that a word speaks against.
    rows += [(500 + i, f"it was 2020-01-{i:02d} or so", "s") for i in range(90)]
    rows += [(600 + i, f"isbn 978 12 {i:04d} of it", "s") for i in range(90)]
    got = {r.doc_id: r for r in pii.find_spans(docs_of(spark, rows)).collect()}
    assert all(got[i].n_added == 1 and got[i].spans == "phone:12:24" for i in range(200, 240))
    assert all(got[i].n_added == 1 and got[i].spans.startswith("ip:5:") for i in range(400, 420))
    assert all(got[i].n_added == 0 for i in got if not (200 <= i < 240 or 400 <= i < 420))
    masked = {r.doc_id: r.text for r in pii.mask(docs_of(spark, rows)).collect()}
    assert masked[200] == "please call <phone> today" and masked[500] == "it was 2020-01-00 or so"


def test_few_loose_combinations_pass_without_votes_of_zero():
    for base, loose in ((200, 40), (1000, 20), (5000, 1)):
        votes = np.array([[1, 1, 1, 1], [0, 0, 1, 1], [0, 0, 0, 1], [0, 0, -1, 1]])
        _, _, chance = pii.reliabilities(votes, np.array([base, loose, 300.0, 30.0]))
        assert chance[1] >= pii.ADD and chance[2] == 0.5 and chance[3] < 0.5


def test_words_against_hold_where_base_spans_have_no_context():
    for base, loose, against in ((157, 30, 30), (200, 1000, 30), (50, 30, 300)):
        votes = np.array([[1, 1, 0, 1], [0, 0, 1, 1], [0, 0, -1, 1]])
        _, _, chance = pii.reliabilities(votes, np.array([base, loose, against], float))
        assert min(chance[:2]) >= pii.ADD and chance[2] <= 0.05


def test_a_long_match_is_judged_as_a_whole():
    short, long = "a@b.com", "a" * 300 + "@b.com"
    votes = [pii.signature(t, "email", 0, len(t), 1) for t in (short, long)]
    assert votes[0] == votes[1]
