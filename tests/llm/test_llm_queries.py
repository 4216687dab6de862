"""Registered queries against their SQL, and the pipeline against a plain version on a small fixture."""

from __future__ import annotations

import hashlib
import os
import random

import corpus_pipeline
import public_tokenizers
import pytest
import tokenizers

from check_queries import compare, connect
from lodewatch.llm import queries, source_mix
from test_simhash import plain_fingerprint, plain_roots

SF_DIR = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@given
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, connect(SF_DIR), queries.QUERIES[name], queries.ORACLE[name], SF_DIR)[0] == "ok"


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")} == set(range(1, 14))
    assert "pipeline" in queries.QUERIES and 4 <= len(corpus_pipeline.STAGES) <= 5


def test_pipeline_equals_a_plain_version(spark, tmp_path):
    rng = random.Random(6)
    vocabulary = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu", "ra") for b in ("t", "n", "s", "vo", "zi", "ber", "dan", "gol")]
    docs = []
    for i in range(90):
        docs.append((i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60, 120))), "en", f"s{i % 4}", 0))
    docs += [(100 + i, docs[i][1].replace(" ", "  "), "en", "s1", 0) for i in range(10)]  # exact copies but for blanks
    docs += [(200 + i, docs[20 + i][1].upper(), "en", "s2", 0) for i in range(10)]  # near copies: equal fingerprints
    docs += [(300, "too short", "en", "s1", 0), (301, "same words " * 40, "en", "s1", 0), (302, None, "en", None, 0), (303, docs[0][1], "en", "s3", 0)]
    labels = [(i, 1) for i in range(90)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert set(stage(spark, frame, str(tmp_path)).columns) == set(frame.columns), name

    left = [d for d in docs if d[1] and len(d[1].split()) >= 50 and d[0] != 301]
    best = {}
    for d in left:
        key = "".join(d[1].split())
        if key not in best or (-len(d[1]), d[0]) < (-len(best[key][1]), best[key][0]):
            best[key] = d
    left = sorted(best.values())
    roots, kept = plain_roots([plain_fingerprint(d[1]) for d in left]), {}
    for d, r in zip(left, roots):
        kept[r] = min(kept.get(r, d), d)
    left = list(kept.values())
    mixed = source_mix.mix(spark.createDataFrame(left, frame.schema)).collect()
    copies = {r["id"]: r["copies"] for r in mixed}
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want = []
    for d in left:
        ids = library.encode(d[1], add_special_tokens=False).ids
        row = (d[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        want += [row] * copies[d[0]]
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == sorted(want)
