"""The pipeline's stages against brute force on the smallest tables, and with odd rows."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from test_op2_quality import slow_counts
from test_op4_line_dedup import brute
from test_op5_mixing import slow_targets
from test_op8_simhash import slow_components, slow_fingerprint
from tidepool.llm import quality

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before and after each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for i, (_, stage) in enumerate(cp.STAGES):
        docs = cp.cut(stage(spark, docs, SF), f"test-{i}")
        if i < len(cp.STAGES) - 1:
            assert docs.columns == COLUMNS
        out.append(docs.collect())
    return out


def test_stage_names():
    assert [n for n, _ in cp.STAGES] == ["quality rules", "line dedup", "SimHash near-dedup", "mixing sources to target weights", "BPE encoding and decoding"]


def test_quality(spark, stages):
    before, after = stages[0], stages[1]
    trees = quality.fit(spark.createDataFrame(before), spark.read.parquet(f"{SF}/labels.parquet"))
    expect = set()
    for r in before:
        n, _, _, _, repeat = slow_counts(r.text)
        score = trees.score(np.array([quality.statistics(r.text.encode())[1]]))[0]
        if n >= 20 and 100 * repeat <= 30 * n and score >= 0.5:
            expect.add(r.doc_id)
    assert {r.doc_id for r in after} == expect and 0 < len(after) < len(before)
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    long_enough = {r.doc_id for r in before if len(r.text.split()) >= 20}
    assert len(good & long_enough & expect) >= 0.97 * len(good & long_enough)


def test_line_dedup(stages):
    before, after = stages[1], {r.doc_id: r for r in stages[2]}
    assert len(after) == len(before)
    for r, (_, text) in zip(before, brute([r.text for r in before], 10)):
        assert after[r.doc_id].text == text and after[r.doc_id].n_chars == len(text)


def test_near_dedup(stages):
    before = sorted(stages[2], key=lambda r: r.doc_id)
    roots = slow_components([slow_fingerprint(r.text) for r in before])
    assert {r.doc_id for r in stages[3]} == {before[i].doc_id for i in set(roots)}
    assert len(stages[3]) == len(set(roots))


def test_mixing(stages):
    before, after = stages[3], stages[4]
    copies = Counter(r.doc_id for r in after)
    by = {r.doc_id: r for r in before}
    assert set(copies) <= set(by) and set(copies.values()) <= {1, 2}
    assert all(tuple(r) == tuple(by[r.doc_id]) for r in after)
    size, taken = defaultdict(int), defaultdict(int)
    for r in before:
        size[r.source] += len(r.text.split())
        taken[r.source] += len(r.text.split()) * copies[r.doc_id]
    target = slow_targets(dict(size))
    largest = max(len(r.text.split()) for r in before)
    assert all(abs(taken[s] - target[s]) <= largest for s in size)


def test_encoding(stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = {r.doc_id: r.text for r in stages[4]}
    assert Counter(r.doc_id for r in stages[5]) == Counter(r.doc_id for r in stages[4])
    for r in stages[5]:
        ids = np.array(library.encode(text[r.doc_id], add_special_tokens=False).ids, "<u4")
        assert bytes(r.ids) == ids.tobytes() and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest() and r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_run_and_reruns_agree(spark, stages):
    rows = lambda rs: Counter((r.doc_id, r.ids_sha256) for r in rs)
    assert rows(cp.run(spark, SF).collect()) == rows(stages[5])


def test_odd_rows(spark):
    good = " ".join(f"word{i} and some plain text" for i in range(30))
    rows = [(1, good, "en", "a", 5), (1, good, "en", "a", 5), (2, None, None, None, None), (None, good + " more", "en", None, 1), (3, "", "en", "a", 0),
            (4, good * 2000, "en", "b", 1), (5, "short", "en", "b", 5)]
    docs = spark.createDataFrame([(*r, "extra", 1, 2) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, kept string, size int, _row int")
    for i, (_, stage) in enumerate(cp.STAGES):
        before = docs.columns
        docs = cp.cut(stage(spark, docs, SF), f"odd-{i}")
        if i < len(cp.STAGES) - 1:
            assert docs.columns == before
    for i, (_, stage) in enumerate(cp.STAGES):
        empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
        assert stage(spark, empty, SF).collect() == []
