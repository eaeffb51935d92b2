"""URL filters: site rules first, then a logistic regression on the address.

A rule is a host and the start of a path. It fits its host and all subdomains of it where
the URL's path begins with its path; of the fitting rules the longest decides, of equally
long ones the first given. Addresses without a rule are judged by a logistic regression on
hashed character n-grams (3 to 5) of host and path, told apart by their field, fitted on a
small labelled table that is a parameter. A probability of 0.5 or more blocks.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
lower case; the path goes on up to ``?``, ``#`` or the end. Null, or no ``://``: both are
empty, no rule fits, and the model sees no n-gram, so its bias decides. Repeated rows are
judged one by one, extra columns ignored. Very long URLs are read whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roost.llm.svm import fit_logistic, sigmoid

BUCKETS = 1 << 15
GRAMS = (3, 4, 5)
PRIOR = 0.4  # probability to block an address without n-grams


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rule(verdict: str, text: str) -> Rule:
    host, slash, path = text.partition("/")
    return Rule(verdict, host, slash + path)


#: Labelled addresses to learn from, one in a line: block or allow, a tab, host and path.
LABELS = Path(__file__).with_name("url_labels.tsv")


def labelled(path: Path = LABELS) -> tuple[list[str], list[str]]:
    """Addresses to block and ordinary ones of a labelled table."""
    rows = [line.split("\t") for line in path.read_text().splitlines() if line]
    return [a for label, a in rows if label == "block"], [a for label, a in rows if label == "allow"]


def with_parts(pages: DataFrame) -> DataFrame:
    """page_id, host, path of each URL."""
    cut = F.expr("substring(url, instr(url, '://') + 3)")
    rest = F.when(F.contains("url", F.lit("://")), cut).otherwise("")
    host = F.translate(F.regexp_extract("rest", r"^[^/?#]*", 0), ascii_uppercase, ascii_lowercase)
    return pages.select("page_id", rest.alias("rest")).select(
        "page_id", host.alias("host"), F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path")
    )


def _fitting(rules: Sequence[Rule]) -> Column:
    """The text and verdict of the longest rule that fits; a rule list is code, not data."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(reversed(rules), key=lambda r: len(r.text)):  # the last one asked first
        fits = ((F.col("host") == r.host) | F.endswith("host", F.lit("." + r.host))) & F.startswith(
            "path", F.lit(r.path)
        )
        answer = F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))
        found = F.when(fits, answer).otherwise(found)
    return found


def _buckets(field: str, text: str) -> list[int]:
    framed = f"^{text}$".encode("utf-8", "surrogatepass")
    salt = zlib.crc32(field.encode())
    return [
        zlib.crc32(framed[i : i + n], salt) % BUCKETS for n in GRAMS for i in range(len(framed) - n + 1)
    ]


def address_grams(host: str, path: str) -> list[int]:
    """Distinct buckets of an address."""
    return sorted({*(_buckets("host", host) if host else ()), *(_buckets("path", path) if path else ())})


def train(blocked: Sequence[str] | None = None, ordinary: Sequence[str] | None = None, penalty: float = 1.0):
    """Weights of the buckets, then the bias; the labelled table is small and given."""
    if blocked is None or ordinary is None:
        blocked, ordinary = labelled()
    addresses = [*blocked, *ordinary]
    x = np.zeros((len(addresses), BUCKETS), np.float32)
    for row, address in enumerate(addresses):
        host, slash, path = address.partition("/")
        grams = address_grams(host, slash + path)
        x[row, grams] = 1 / np.sqrt(len(grams))
    # Held near 0, the bias leaves it to the n-grams to speak for either side.
    labels = np.repeat([1.0, 0.0], [len(blocked), len(ordinary)])
    weights = fit_logistic(x * 8, labels, penalty, bias_penalty=1000.0)
    weights[-1] += np.log(PRIOR / (1 - PRIOR))
    return weights.astype(np.float32)


def probability(weights: np.ndarray, host: str, path: str) -> float:
    grams = address_grams(host, path)
    reached = weights[grams].sum() * (8 / np.sqrt(len(grams))) if grams else 0.0
    return float(sigmoid(float(reached) + float(weights[-1])))


def judge(pages: DataFrame, rules: Sequence[Rule], weights: np.ndarray) -> DataFrame:
    """page_id, host, path, rule, verdict and the model's probability to block."""
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def blocks(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        known = lru_cache(10_000)(lambda host, path: probability(shared.value, host, path))
        return pd.Series([known(h, p) for h, p in zip(hosts, paths)], dtype=float)

    rows = with_parts(pages).withColumn("fit", _fitting(rules)).withColumn("probability", blocks("host", "path"))
    own = F.when(F.col("probability") >= 0.5, "block").otherwise("allow")
    return rows.select(
        "page_id",
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", own).alias("verdict"),
        "probability",
    )
