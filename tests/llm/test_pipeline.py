"""The pipeline's rows against a brute-force version on a small corpus."""

import zlib

import duckdb
import numpy as np

import corpus_pipeline
from mapjobs.llm import mixing
from tests.llm.test_operators import BPE, brute_components, brute_fingerprint, prose

GERMAN = "der sch ung keit ein ü".split()


def test_pipeline(spark, tmp_path):
    from tokenizers import Tokenizer

    rows = []
    for i in range(60):
        text = prose(i, 40 + i) if i % 3 else prose(i, 50, GERMAN)
        rows.append((i, text, "en" if i % 3 else "de", f"s{i % 4}", 5))
    item = prose(500, 15)
    rows += [(60, rows[7][1], "en", "s1", 5), (61, "12 34 !!", None, "s1", 5), (62, None, "en", None, 5), (63, f"{prose(63, 20)} {item}", "en", "s2", 5), (64, f"{prose(64, 600)} {item}", "en", None, 5), (65, rows[8][1], "en", "s0", 5), (65, rows[8][1], "en", "s0", 5)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    kept = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    component = brute_components([r[0] for r in kept], [brute_fingerprint(r[1]) for r in kept])
    kept = list({r[0]: r for r, c in zip(kept, component) if r[0] == c}.values())
    assert {7, 8, 63, 64} <= {r[0] for r in kept} and not {60, 61, 62, 65} & {r[0] for r in kept}
    kept = [r for r in kept if not (item in r[1] and 20 * 15 >= len(r[1].split()))]
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    db.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", kept)
    times = {d: taken // size for d, size, _, _, taken in db.execute(mixing.SQL).fetchall()}
    t, want, at = Tokenizer.from_file(BPE), [], 0
    for r in sorted(kept):
        ids = np.array(t.encode(r[1], add_special_tokens=False).ids + [0], "<u4")
        for _ in range(times[r[0]]):
            want.append((r[0], at, len(ids), zlib.crc32(ids.tobytes())))
            at += len(ids)
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == want and len(want) > 30
    docs = corpus_pipeline.known_language(spark, documents, str(tmp_path))
    for name, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, docs, str(tmp_path)).columns == documents.columns, name
    empty = documents.limit(0)
    empty.write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_rows_that_share_an_id(spark, tmp_path):
    """Every row is judged by itself: near copies, benchmark passages and mixing of rows that share a doc_id, or have none; columns of clashing names."""
    item = prose(900, 40)
    rows = [(9, prose(1, 80), "en", "a", "mine", 1, 5), (9, prose(2, 80), "en", "a", "mine", 2, 5), (9, f"{prose(3, 80)} {item}", "en", "b", "k", 3, 5), (9, prose(1, 80), "en", "a", "mine", 1, 5),
            (None, prose(4, 80), "en", None, "x", 4, 5), (None, prose(5, 80), "de", "b", "y", 5, 5), (3, prose(5, 80), "de", "b", "z", 6, 5), (4, None, None, None, None, None, None), (5, "", "en", "a", "e", 1, 5)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, __key string, __times long, row int")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    same = lambda x: sorted(map(str, map(tuple, x)))
    # null and empty texts are one group, and so are the two equal rows, and the copy without an id and row 3
    got = corpus_pipeline.near_dedup(spark, d, str(tmp_path))
    assert got.columns == d.columns and same(got.collect()) == same([rows[0], rows[1], rows[2], rows[4], rows[6], rows[7]])
    got = corpus_pipeline.decontaminated(spark, d, str(tmp_path))
    assert got.columns == d.columns and same(got.collect()) == same([r for r in rows if r != rows[2]])
    got = corpus_pipeline.mixed(spark, d, str(tmp_path)).collect()
    times = {}
    for r in mixing.mix(d).collect():
        times[r.doc_id, r.source] = r.repeats
    assert same(got) == same([r for r in rows for _ in range(times[r[0], r[3]])])
    assert same(corpus_pipeline.near_dedup(spark, d.limit(0), str(tmp_path)).collect()) == []
