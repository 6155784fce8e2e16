"""Quality rules kept as a ledger of failure bits.

Every rule is evaluated once per document. The ledger stores what was measured
and one bit per failed rule; a policy is a named, versioned set of rules, that
is a mask over the bits. Changing a policy, or asking what a rule contributes,
reads the ledger alone.

Defined results: a null or empty text has no words and fails ``few_words`` only.
Repeated rows are measured each for itself. Columns of the input pass through;
one that is named like the ledger column is replaced by it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.llm.common import column

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_lower",
)


@dataclass(frozen=True)
class Rule:
    """``fails`` maps the struct of measures to a condition that is never null."""

    name: str
    fails: Callable[[Column], Column]


@dataclass(frozen=True)
class Policy:
    """A document is rejected if it fails any of the named rules."""

    name: str
    version: int
    rules: tuple[str, ...]


RULES = (
    Rule("few_words", lambda m: m["n_words"] < 50),
    Rule("repeated_words", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    Rule("symbols", lambda m: 5 * m["n_symbols"] > m["n_words"]),
    Rule("repeated_lines", lambda m: (m["n_lines"] >= 4) & (2 * m["n_dup_lines"] > m["n_lines"])),
    Rule("word_length", lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 20 * m["n_words"])),
    Rule("shouting", lambda m: m["n_upper"] > m["n_lower"]),
)
BASE = Policy("base", 1, ("few_words", "repeated_words"))
DEFAULT = Policy("default", 1, tuple(r.name for r in RULES))


def measure_text(text: str | None) -> tuple[int, ...]:
    """The measures of one text, in the order of MEASURES."""
    if not text:
        return (0,) * len(MEASURES)
    raw = text.encode()
    words = raw.split()  # splits at exactly the white space of SPACES
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    letters = np.frombuffer(raw, np.uint8)
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
        int(np.count_nonzero((letters >= ord("A")) & (letters <= ord("Z")))),
        int(np.count_nonzero((letters >= ord("a")) & (letters <= ord("z")))),
    )


def repeated_words(words: Sequence[bytes]) -> int:
    """Words inside a window of three words that the text holds twice or more."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) >= 1 << 20:  # three numbers would not fit one 64-bit key
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    windows = pairs[:-1] * len(number) + ids[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = np.zeros(len(ids), bool)
    for shift in range(3):
        inside[shift : shift + len(windows)] |= twice
    return int(np.count_nonzero(inside))


@F.arrow_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def _measured(texts: pa.Array) -> pa.Array:
    rows = [measure_text(t.as_py()) for t in texts]
    columns = zip(*rows) if rows else [()] * len(MEASURES)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(MEASURES))


def ledger(
    docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, into: str = "quality"
) -> DataFrame:
    """``docs`` with a struct ``into``: every measure, and ``failed`` with bit i set for a failed rule i."""
    if len(rules) > 63:
        raise ValueError("a ledger holds 63 rules at most")
    measured = docs.withColumn(into, _measured(column(text)))
    measures = column(into)
    failed = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        failed = failed.bitwiseOR(F.when(rule.fails(measures), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn(into, F.struct(*[measures[m].alias(m) for m in MEASURES], failed.alias("failed")))


def mask(policy: Policy, rules: Sequence[Rule] = RULES) -> int:
    names = [r.name for r in rules]
    return sum(1 << names.index(n) for n in set(policy.rules))


def rejected(policy: Policy, rules: Sequence[Rule] = RULES, into: str = "quality") -> Column:
    """Whether a row of a ledger fails the policy."""
    return column(into)["failed"].bitwiseAND(F.lit(mask(policy, rules))) != 0


def ablations(
    ledgers: DataFrame, policies: Sequence[Policy], rules: Sequence[Rule] = RULES, into: str = "quality"
) -> DataFrame:
    """Per policy and rule: rows that fail it, and rows that only it rejects.

    Rows are first counted per pattern of bits, so what meets in a group is one
    row per task and pattern; no text is read again.
    """
    patterns = ledgers.groupBy(column(into)["failed"].alias("failed")).agg(F.count("*").alias("rows"))
    names = [r.name for r in rules]
    asked = F.array(*[
        F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(n).alias("rule"),
                 F.lit(1 << names.index(n)).cast("long").alias("bit"), F.lit(mask(p, rules)).cast("long").alias("mask"))
        for p in policies for n in p.rules
    ])
    each = patterns.select("failed", "rows", F.explode(asked).alias("q"))
    hit = F.col("failed").bitwiseAND(F.col("q.bit")) != 0
    alone = F.col("failed").bitwiseAND(F.col("q.mask")) == F.col("q.bit")
    return each.groupBy("q.policy", "q.version", "q.rule").agg(
        F.sum(F.when(hit, F.col("rows")).otherwise(0)).alias("failing"),
        F.sum(F.when(alone, F.col("rows")).otherwise(0)).alias("only_this"),
    )
