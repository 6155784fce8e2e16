"""The pipeline's stages, one after the other, against brute force on the smallest folder."""

from collections import Counter

import numpy as np
import pytest
import test_table_operators as tables
import test_text_operators as texts
import tiktoken
from conftest import TESTDATA

import __spark_entry__ as entry
import corpus_pipeline
from martline.llm import byte_bpe, line_dedup, mixing, quality
from martline.llm.queries import PATTERN, RANKS
from martline.sources.staging import stage


@pytest.fixture(scope="module")
def steps(spark):
    """The rows before the first and after each stage."""
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    out = [docs.collect()]
    for _, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, str(TESTDATA)))
        out.append(docs.collect())
    return out


def test_stages_are_the_ones_asked_for(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near-dedup", "source mixing", "byte-level BPE"]
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    for rows in steps[:-1]:
        assert rows and rows[0].__fields__ == steps[0][0].__fields__


def test_quality_stage(steps):
    def junk(text):
        n, chars, symbols, dups, repeats = texts.measured(text)
        lines = [x for x in (text or "").split("\n") if x.strip()]
        upper, lower = (sum(a <= c <= z for c in text or "") for a, z in (("A", "Z"), ("a", "z")))
        return (n < 50 or 2 * repeats > n or 5 * symbols > n or (len(lines) >= 4 and 2 * dups > len(lines))
                or chars < 2 * n or chars > 20 * n or upper > lower)

    assert sorted(steps[1]) == sorted(r for r in steps[0] if not junk(r.text))
    assert quality.DEFAULT.rules == tuple(r.name for r in quality.RULES)


def test_line_dedup_stage(steps):
    rows = steps[1]
    expected = texts.lines_dropped([(r.source, r.text) for r in rows], line_dedup.MAX_RATIO, line_dedup.MIN_PAGES)
    got = sorted((r.doc_id, r.source, r.text, r.n_chars) for r in steps[2])
    assert got == sorted((r.doc_id, s, t, len(t)) for r, (s, t) in zip(rows, expected))


def test_near_dedup_stage(steps):
    rows = [(r.doc_id, r.text) for r in steps[2]]
    kept = {key for key, n, component in tables.components(rows, 5) if not n or key == component}
    assert sorted(r.doc_id for r in steps[3]) == sorted(kept)


def test_mixing_stage(steps):
    words, goal = Counter(), Counter()
    for r in steps[3]:
        words[r.source] += len((r.text or "").split())
    for r in steps[4]:
        goal[r.source] += len((r.text or "").split())
    known = {r.doc_id: r for r in steps[3]}
    assert all(known[r.doc_id] == r for r in steps[4])
    assert max(Counter(r.doc_id for r in steps[4]).values()) <= 3
    for source, target in tables.brute_targets(words, mixing.WEIGHTS, 3).items():
        largest = max(len((r.text or "").split()) for r in steps[3] if r.source == source)
        assert target - largest <= goal[source] <= target + 1e-6


def test_encoding_stage(steps):
    plain = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=byte_bpe.encoding(RANKS, PATTERN)._mergeable_ranks, special_tokens={})
    expected = Counter((r.doc_id, np.array(plain.encode_ordinary(r.text or ""), "<u4").tobytes()) for r in steps[4])
    assert Counter((r.doc_id, bytes(r.tokens)) for r in steps[5]) == expected
    assert all(r.round_trip and r.n_tokens * 4 == len(r.tokens) for r in steps[5])


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{TESTDATA}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
