"""URL filter: host and path rules first, then logistic regression on hashed character n-grams of host and path.

The rules are a short list that travels inside the plan. Where no rule fits, a model decides that is trained from a
small labelled URL table; its weights are a fixed-size vector (``BITS``), so what reaches the tasks never grows.

Defined cases: a null URL or one without ``://`` has an empty host and path and no rule, and the model judges the empty
text; repeated rows are judged alike; an empty table gives an empty result; columns of the input that clash with those added
are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import ascii_lower

RULES = (
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"),
)

BITS = 13
GRAMS = (3, 4, 5)

# The small labelled URL table is built from words that hosts of wanted and unwanted sites are made of.
WANTED = (
    "library", "garden", "history", "news", "daily", "docs", "software", "recipes", "science", "university", "travel", "weather", "museum", "teacher",
    "forum", "music", "health", "poetry", "wiki", "parliament", "cooking", "nature", "school", "theatre", "stories", "letters", "research", "village",
    "journal", "archive", "painting", "mountain", "river", "language", "reader", "thought",
)
UNWANTED = (
    "cheap", "pills", "spam", "farm", "casino", "bonus", "win", "money", "free", "bets", "adult", "xxx", "porn", "payday", "loans", "crack", "warez", "poker",
    "replica", "viagra", "lottery", "clickbait", "keygen", "jackpot",
)


def labelled_urls() -> list[tuple[str, str]]:
    """url, label (allow or block): each word alone and joined with others, under changing prefixes, domains and paths."""
    rows = []
    for label, words, steps in (("allow", WANTED, (0, 1, 7, 11, 17)), ("block", UNWANTED, (0, 1, 7))):
        for i, word in enumerate(words):
            for k, step in enumerate(steps):
                host = word if not step else f"{word}-{words[(i + step) % len(words)]}"
                for n in range(4):  # the same hosts with other prefixes, domains and paths
                    prefix, domain, language = ("", "www.", "blog.", "m.")[(i + k + n) % 4], ("com", "net", "org")[(i + n) % 3], ("en", "es", "fr", "de")[(k + n) % 4]
                    rows.append((f"https://{prefix}{host}.example.{domain}/{language}/{zlib.crc32(f'{i} {n}'.encode()) % 1000}", label))
    return rows


def host_column(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_column(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits (of equally long ones the first by text), else null.

    A rule fits its host, every subdomain of it, and the paths that start with its own.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    if not ordered:
        return F.lit(None).cast("string"), F.lit(None).cast("string")

    def fits(r: tuple[str, str, str]) -> Column:
        return ((host == r[0]) | host.endswith("." + r[0])) & path.startswith(r[1])

    def first(values: list[str]) -> Column:
        return F.coalesce(*[F.when(fits(r), F.lit(v)) for r, v in zip(ordered, values, strict=True)])

    return first([r[0] + r[1] for r in ordered]), first([r[2] for r in ordered])


def grams(host: str, path: str) -> np.ndarray:
    """Distinct hashed n-grams of host and path; the marks keep their ends and the two parts apart."""
    found = set()
    for mark, text in ((1, f"^{host}$"), (2, f"^{path}$")):
        raw = text.encode()
        for n in GRAMS:
            found.update(zlib.crc32(raw[i : i + n], mark) & ((1 << BITS) - 1) for i in range(len(raw) - n + 1))
    return np.fromiter(sorted(found), np.int64, len(found))


def train(urls: Sequence[tuple[str, str, bool]], rounds: int = 200, rate: float = 10.0, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias for (host, path, block) rows: gradient descent with weight decay on length-normalised features."""
    rows = [grams(h, p) for h, p, _ in urls]
    used, at = np.unique(np.concatenate(rows or [np.zeros(0, np.int64)]), return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    x = np.zeros((len(rows), len(used)), np.float32)
    x[owner, at] = 1 / np.sqrt(np.bincount(owner, minlength=len(rows)))[owner]
    y = np.array([float(b) for *_, b in urls], np.float32)
    w, bias = np.zeros(len(used), np.float32), 0.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-(x @ w + bias))) - y
        w -= rate * (x.T @ error / max(1, len(y)) + decay * w)
        bias -= 0.05 * rate * float(error.mean()) if len(y) else 0.0
    weights = np.zeros(1 << BITS)
    weights[used] = w
    return weights, bias


def scorer(weights: np.ndarray, bias: float):
    """The model as a column function of host and path: the chance of "block"."""
    w = weights.astype(np.float64)

    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hosts, paths in parts:
            out = []
            for h, p in zip(hosts, paths, strict=True):
                g = grams(h, p)
                out.append(w[g].sum() / np.sqrt(max(1, len(g))) + bias)
            yield pd.Series(1 / (1 + np.exp(-np.array(out, dtype=float))))

    return score


def judge(
    pages: DataFrame, labelled: DataFrame | None = None, rules: Sequence[tuple[str, str, str]] = RULES, max_labelled: int = 10_000
) -> DataFrame:
    """``pages`` (a column ``url``) with host, path, rule, block_score and verdict.

    ``labelled`` has url and label (allow or block); training takes at most ``max_labelled`` of its rows, the first by hash.
    """
    table = labelled if labelled is not None else pages.sparkSession.createDataFrame(labelled_urls(), "url string, label string")
    bounded = table.orderBy(F.xxhash64("url")).limit(max_labelled)
    parts = bounded.select(host_column(F.col("url")).alias("h"), path_column(F.col("url")).alias("p"), (F.col("label") == "block").alias("b")).collect()
    weights, bias = train([(r.h, r.p, bool(r.b)) for r in sorted(parts, key=tuple)])
    added = ["host", "path", "rule", "block_score", "verdict"]
    base = pages.drop(*added).withColumns({"host": host_column(F.col("url")), "path": path_column(F.col("url"))})
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    scored = base.withColumn("block_score", scorer(weights, bias)("host", "path"))
    by_model = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return scored.withColumn("rule", rule).withColumn("verdict", F.coalesce(verdict, by_model))


def keep_allowed(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("verdict") == "allow")
