"""The five stages on about a hundred documents against a plain statement of each."""

import random
from collections import Counter

import numpy as np

import corpus_pipeline
from pairscope.llm import langid, sharding

from .data import SCHEMA, edited, messy_rows, union_find
from .test_exact_sharding_mixing import expected_counts
from .test_lines_and_benchmark import brute_containment
from .test_simhash import plain_fingerprint


def written(spark, tmp_path):
    rng = random.Random(17)
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()] + [(900, "rare wording")]
    rows = [r for r in messy_rows(spark, 70) if r[0] is not None and r[0] != 9005]
    rows = list({r[0]: r for r in rows}.values())
    def filler(k):
        words = rows[k][1].split(" ")
        return " ".join(rng.sample(words, len(words)))
    rows += [(20_000 + k, edited(rng, rows[k][1], 0.002), "en", "src1", 1) for k in range(12)]
    rows += [(21_000 + k, f"{filler(20 + k)} {items[k][1]} {filler(40 + k)}", "en", f"src{k % 3}", 1) for k in range(8)]
    rows += [(22_000, f"{filler(30)} with a Rare, wording in it", "en", "src2", 1), (22_001, "Привет мир как дела сегодня", "en", "src2", 1)]
    path = str(tmp_path)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def test_pipeline_against_plain_stages(spark, tmp_path):
    path, rows, items = written(spark, tmp_path)
    model = langid.fit(spark.read.parquet(f"{path}/documents.parquet"))
    k = len(model.classes)

    def identified(text):
        counts = langid.gram_counts(text)
        if counts is None:
            return False
        return (model.probabilities(counts).max() >= 1 / k + (1 - 1 / k) / 15 and counts[np.flatnonzero(model.seen)].sum() >= 0.5 * counts.sum())
    kept = [r for r in rows if identified(r[1])]
    assert len(rows) - 12 < len(kept) < len(rows)
    fps = [plain_fingerprint(r[1]) for r in kept]
    roots = union_find(len(kept), [(i, j) for i in range(len(kept)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    best = {}
    for r, root in zip(kept, roots):
        if root not in best or r[0] < best[root][0]:
            best[root] = r
    unique = list(best.values())
    assert len(unique) < len(kept) - 8
    dirty = {d for d, *_ in brute_containment(unique, items)}
    clean = [r for r in unique if r[0] not in dirty]
    assert {21_000 + k for k in range(8)} & {r[0] for r in unique} <= dirty
    assert 22_000 in dirty and len(clean) > 60
    want = expected_counts(clean, seed=corpus_pipeline.MIX_SEED)

    got = corpus_pipeline.run(spark, path).collect()
    assert Counter((r.doc_id, r.text) for r in got) == want
    n = sum(want.values())
    assert sorted(r.row_number for r in got) == list(range(n))
    for r in got:
        p = sharding.permute_python(r.row_number, n, corpus_pipeline.SHARD_SEED)
        assert (r.shard, r.slot) == (p % 16, p // 16)
