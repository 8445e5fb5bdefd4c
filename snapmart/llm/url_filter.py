"""URL filter: allow and block rules, else logistic regression on character n-grams.

Rules name a host suffix and a path prefix; the longest that fits decides.
URLs without a rule are judged by a logistic regression on hashed character
n-grams (``GRAMS``) of host and path, which are kept apart. It is trained on a
small labelled table: fixed seed URLs and the distinct URLs of the data that
have a label, at most ``MAX_LABELLED`` of each label, chosen by hash (a
documented bound). Training runs on the driver over that table; the model is
one vector of ``BUCKETS`` weights.

Edge cases: a null url or one without ``://`` has an empty host and path, no
rule, and the model's verdict on nothing, which is allow. Only A-Z are
lower-cased. Repeated rows are judged alike; an empty table gives no rows;
extra columns are not read. Without labelled rows the seeds alone train.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import small_batches

GRAMS = (3, 4, 5)
BUCKETS = 1 << 16
MAX_LABELLED = 2000
BLOCK_AT = 0.5

# Upper and lower case letters of the contract, seed words and seed URLs.
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words in a host that mark it as unwanted; they label the training table only.
BLOCK_WORDS = ("casino", "pills", "porn", "adult", "spam", "bets", "ads-track", "xxx", "viagra", "poker", "warez", "malware")
SEEDS = (
    ("http://cheap-pills.example.net/en/1", 1),
    ("https://casino-win.example.com/play", 1),
    ("http://free-bets.example.net/bonus", 1),
    ("https://adult-x.example.com/video/7", 1),
    ("http://spam-farm.example.org/links", 1),
    ("http://ads-track.example.com/click", 1),
    ("http://online-poker.example.com/win", 1),
    ("https://buy-viagra.example.org/shop", 1),
    ("http://warez-files.example.net/dl", 1),
    ("https://xxx-cams.example.com/live", 1),
    ("https://www.library.example.org/en/books/1", 0),
    ("https://news.example.com/en/2020/05/story.html", 0),
    ("https://blog.garden.example.org/de/roses/", 0),
    ("https://docs.example.net/en/manual", 0),
    ("https://m.weather.example.com/fr/paris", 0),
    ("http://www.school.example.org/es/curso", 0),
    ("https://wiki.example.org/en/History", 0),
    ("https://museum.example.net/fr/expositions", 0),
    ("http://university.example.com/en/research.html", 0),
    ("https://recipes.example.net/es/cocina/12", 0),
)


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url column; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _UPPER.lower()), path


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct of ``rule`` and ``verdict`` of the longest rule that fits; null without one."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = (host == r.host) | host.endswith("." + r.host)
        out = F.when(fits & path.startswith(r.path), F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def parsed(urls: DataFrame, key: str, rules: Sequence[Rule]) -> DataFrame:
    """``key, host, path, rule, verdict`` (the last two null without a rule)."""
    host, path = host_and_path(F.col("url"))
    split = urls.select(F.col(key), host.alias("host"), path.alias("path"))
    judged = split.withColumn("judged", rule_of(F.col("host"), F.col("path"), rules))
    return judged.select(key, "host", "path", "judged.rule", "judged.verdict")


def hashed_grams(host: str, path: str) -> np.ndarray:
    """Buckets of the distinct character n-grams of host and path."""
    out = set()
    for mark, part in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in GRAMS:
            out.update(zlib.crc32(f"{mark}{part[i : i + n]}".encode()) % BUCKETS for i in range(len(part) - n + 1))
    return np.fromiter(sorted(out), np.int64, len(out))


def fit(rows: list[tuple[str, str, int]], rounds: int = 60, rate: float = 0.5, decay: float = 1e-4) -> np.ndarray:
    """Weights (the last is the offset) by batch steps with adaptive rates; both labels weigh the same."""
    weights = np.zeros(BUCKETS + 1)
    grams = [hashed_grams(h, p) for h, p, _ in rows]
    y = np.array([label for *_, label in rows], float)
    share = np.where(y > 0, 0.5 / max(1.0, y.sum()), 0.5 / max(1.0, (1 - y).sum()))
    flat = np.concatenate(grams)
    owner = np.repeat(np.arange(len(grams)), [g.size for g in grams])
    length = 1.0 / np.sqrt(np.maximum(1, np.bincount(owner, minlength=len(grams))))
    seen = np.full(BUCKETS + 1, 1e-8)
    for _ in range(rounds):
        z = np.bincount(owner, weights=weights[flat], minlength=len(grams)) * length + weights[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * share
        grad = np.bincount(flat, weights=(error * length)[owner], minlength=BUCKETS + 1) + decay * weights
        grad[-1] = error.sum()
        seen += grad * grad
        weights = weights - rate * grad / np.sqrt(seen)
    return weights


def chance(weights: np.ndarray, host: str, path: str) -> float:
    """Chance that a URL is unwanted; 0 for an empty host and path."""
    if not host and not path:
        return 0.0
    g = hashed_grams(host, path)
    z = weights[g].sum() / np.sqrt(max(1, g.size)) + weights[-1]
    return float(1 / (1 + np.exp(-min(30.0, max(-30.0, z)))))


def labelled_table(urls: DataFrame, label: Column, bound: int = MAX_LABELLED) -> DataFrame:
    """``host, path, label`` of at most ``bound`` distinct URLs per label, chosen by hash.

    ``label`` is a column over ``host`` and ``path``: 1 unwanted, 0 wanted, null unknown.
    """
    host, path = host_and_path(F.col("url"))
    rows = urls.select(host.alias("host"), path.alias("path")).filter("host <> ''").distinct().withColumn("label", label)
    order = F.xxhash64("host", "path")
    some = [rows.filter(F.col("label") == k).orderBy(order, "host", "path").limit(bound) for k in (0, 1)]
    return some[0].unionByName(some[1])


def weak_label(words: Sequence[str] = BLOCK_WORDS) -> Column:
    """1 where the host holds one of the words, else 0."""
    hit = F.lit(False)
    for w in words:
        hit = hit | F.contains(F.col("host"), F.lit(w))
    return hit.cast("int")


def train(urls: DataFrame, label: Column | None = None, bound: int = MAX_LABELLED) -> np.ndarray:
    """Weights from the seeds and the labelled table (at most two times ``bound`` rows)."""
    table = labelled_table(urls, weak_label() if label is None else label, bound)
    rows = [(r.host, r.path, r.label) for r in table.collect()]
    for url, mark in SEEDS:
        host, _, path = url.split("://", 1)[1].partition("/")
        rows.append((host, "/" + path, mark))
    return fit(rows)


def judge_urls(urls: DataFrame, key: str, rules: Sequence[Rule] = RULES, weights: np.ndarray | None = None) -> DataFrame:
    """``key, host, path, rule, verdict, chance`` of every url; ``chance`` is null where a rule decided."""
    small_batches(urls.sparkSession)
    model = train(urls) if weights is None else weights
    kind = dict(urls.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            verdicts, chances = [], []
            for host, path, verdict in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(4).to_pylist(), strict=True):
                p = chance(model, host, path) if verdict is None else None
                chances.append(p)
                verdicts.append(verdict if p is None else "block" if p >= BLOCK_AT else "allow")
            columns = [*b.columns[:4], pa.array(verdicts, pa.string()), pa.array(chances, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [key, "host", "path", "rule", "verdict", "chance"])

    return parsed(urls, key, rules).mapInArrow(run, f"`{key}` {kind}, host string, path string, rule string, verdict string, chance double")
