"""The pipeline: every stage against a plain version on what the stage before it kept."""

import zlib
from collections import Counter, defaultdict

import duckdb
from test_text_operators import WORD, plain_groups, plain_mix
from tokenizers import Tokenizer

import corpus_pipeline
from skyloom.llm import quality, suite
from skyloom.session import scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_equal_plain_versions(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    kept, places = [], []
    for _, stage in corpus_pipeline.STAGES:
        places.append(scratch(spark, "stage"))
        stage(spark, docs, folder).write.parquet(places[-1])
        docs = spark.read.parquet(places[-1])
        kept.append(docs.collect())
    good, lines, single, mixed, packed = kept
    assert all(spark.read.parquet(p).columns == COLUMNS for p in places[:-1])

    # classifier: what it rejects goes, nothing else
    judged = quality.classify(spark.read.parquet(f"{folder}/documents.parquet"), labels).collect()
    assert Counter(r.doc_id for r in good) == Counter(r.doc_id for r in judged if r.predicted == 1)

    # line dedup: every document stays, with the lines that SQL keeps
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{places[0].removeprefix('file://')}/*.parquet'")
    want = Counter(con.execute(f"SELECT doc_id, kept_md5 FROM ({suite.ORACLES['op7_line_templates']})").fetchall())
    con.execute(f"CREATE VIEW cleaned AS SELECT * FROM '{places[1].removeprefix('file://')}/*.parquet'")
    assert Counter(con.execute("SELECT doc_id, md5(coalesce(text, '')) FROM cleaned").fetchall()) == want

    # near-dedup: the smallest id of each group
    _, groups = plain_groups([(r.doc_id, r.text, r.source) for r in lines], 5, (80, 100))
    assert Counter(r.doc_id for r in single) == Counter(min(ids) for ids in groups.values())
    texts = {r.doc_id: r.text for r in lines}
    assert all(r.text == texts[r.doc_id] for r in single)

    # mix: each source ends at its target
    _, target = plain_mix([(r.doc_id, r.text, r.source) for r in single], share=1.0)
    words = defaultdict(int)
    for r in mixed:
        words[r.source] += len(WORD.findall(r.text or ""))
    assert {s: n for s, n in words.items()} == {s: int(target[s] + 1e-9) for s in words}

    # packing: the ids of every row, in sequences without gaps
    tokenizer, want = Tokenizer.from_file(suite.TOKENIZER), Counter()
    for r in mixed:
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        for k, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            want[(r.doc_id, k, start, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want

    # the whole run gives the same pieces
    again = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in again) == Counter((r.doc_id, r.piece, r.ids_crc32) for r in packed)


def test_oracle_types(spark, folder):
    from compare import duck

    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    con = duck(folder)
    for name, sql in suite.ORACLES.items():
        got = {f.name: kinds[f.dataType.simpleString()] for f in suite.QUERIES[name](spark, folder).schema}
        assert got == {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}, name
