"""Vector operators and archives against brute force."""

import base64
import hashlib
import io
import zipfile
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from compare import compare, duck

from skyloom.llm import suite, topk, vectors, warczip
from skyloom.llm.common import components
from skyloom.session import scratch

SCHEMA = "vec_id long, embedding array<float>, label int, node string, v int, side int, dim string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, 2, "y") for i, v, label in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    found = []
    for i in range(500):
        spread = 0.12 if i % 3 else 0.5
        found.append((i, (centres[i % 12] * 0.3 + spread * 0.3 * rng.normal(size=16)).tolist(), i % 12 % 3))
    found += [(1000 + i, found[7][1], found[7][2]) for i in range(60)]  # exact copies
    found += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 16, 1), (2003, [float("nan")] * 16, 1), (2004, [1.0] * 15 + [None], 1)]
    found += [(2005, [float("inf")] + [1.0] * 15, 1), (2006, found[7][1], None), (2007, [0.5, 0.5], 1), (None, found[8][1], found[8][2])]
    found += [(2050, [1e30] * 16, 2), (2100, found[20][1], found[20][2]), (2100, found[20][1], found[20][2])]
    return found


def fit(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(np.float32(x)) for x in v)


def test_top_k_equals_brute_force(spark, rows):
    df = table(spark, rows)
    got = topk.search(df, df.where("vec_id % 50 = 0"), block=64).collect()
    scaled = {}
    for i, v, _ in rows:
        if i is not None and fit(v):
            scaled[i] = np.array([int(x) for x in np.floor(256 * np.array(v, np.float32).astype(float))], object)
    want = set()
    for q in (i for i in scaled if i % 50 == 0):
        ranked = sorted((-int(scaled[q] @ c), i) for i, c in scaled.items() if i != q and len(c) == len(scaled[q]))
        want |= {(q, n + 1, i, max(min(-s, 2**63 - 1), -(2**63))) for n, (s, i) in enumerate(ranked[:5])}
    assert 2050 in scaled and {(r.query_id, r.rank, r.vec_id, r.score) for r in got} == want and len(got) == len(want)
    assert topk.search(table(spark, []), table(spark, [])).count() == 0


def test_top_k_of_large_components(spark):
    rng = np.random.default_rng(8)
    schema = "vec_id long, embedding array<double>"
    size = [1.0, 5e3, 1e6, 1e9, 1e13, 3e16]
    rows = [(i, (rng.normal(size=6).clip(-1, 1) * size[i % 6]).tolist()) for i in range(240)]
    rows += [(300 + i, [5000.0, 0.0, 0.0, 0.0, 0.0, i % 3 / 256]) for i in range(8)]  # scores that float64 cannot tell apart
    rows += [(400 + i, [3e16, 3e16, 0.0, 0.0, 0.0, i % 3 / 256]) for i in range(8)]
    rows += [(510 + i, [1e30, 1.0, 0.0, 0.0, 0.0, i / 256]) for i in range(3)]
    rows += [(500, [-1e300] * 6), (501, [-3.7e16] * 6), (502, [1e308] * 6), (503, [4097.0] * 6)]
    df = spark.createDataFrame(rows, schema)
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows if max(map(abs, v)) < 2.0**1016}
    assert 501 in whole and 500 in whole and 502 not in whole
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.search(df, df.where("vec_id % 10 = 0"), block=64).collect()}
    want = {}
    for q in (i for i in whole if i % 10 == 0):
        ranked = sorted((-sum(a * b for a, b in zip(whole[q], c, strict=True)), i) for i, c in whole.items() if i != q)
        want |= {(q, n + 1): (i, max(min(-s, 2**63 - 1), -(2**63))) for n, (s, i) in enumerate(ranked[:5])}
    assert got == want and any(s == 2**63 - 1 for _, s in want.values())


def test_whole_numbers_stand_in_order():
    rng = np.random.default_rng(4)
    values = [0, 1, -1, 255, 256, -255, -256, 2**64, -(2**64), 2**2040, -(2**2040)] + [int(x) for x in rng.integers(-(2**40), 2**40, 300)]
    assert sorted(values) == sorted(values, key=topk.in_order)


def test_top_k_of_components_beyond_float_sums_equals_sql(spark, tmp_path):
    con = duckdb.connect()
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(size=8) * (1e6 if i % 4 == 0 else 1.0)]) for i in range(120)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    name = "op9_pivot_top_k"
    ok, note, n = compare(spark, con, str(tmp_path), name, suite.QUERIES[name], suite.ORACLES[name])
    assert ok and n == 15, note


def test_top_k_query_equals_sql(spark, folder):
    name = "op9_pivot_top_k"
    ok, note, _ = compare(spark, duck(folder), folder, name, suite.QUERIES[name], suite.ORACLES[name])
    assert ok, note


@pytest.mark.parametrize(("cell", "block"), [(40, 16), (2048, 1024)])
def test_near_vectors_equal_brute_force(spark, rows, cell, block, monkeypatch):
    monkeypatch.setattr(vectors, "CELL", cell)
    monkeypatch.setattr(vectors, "BLOCK", block)
    got = vectors.near_duplicates(table(spark, rows)).collect()
    n = len(rows)
    points = [np.array(v, np.float32).astype(float) if fit(v) and np.any(np.array(v)) else None for _, v, _ in rows]
    linked = np.zeros((n, n), bool)
    for a in range(n):
        for b in range(n):
            x, y = points[a], points[b]
            if a != b and x is not None and y is not None and len(x) == len(y) and rows[a][2] is not None and rows[a][2] == rows[b][2]:
                linked[a, b] = (x / np.linalg.norm(x)) @ (y / np.linalg.norm(y)) >= 0.93
    label = np.arange(n)
    while True:
        now = np.minimum(label, np.where(linked, label[None, :], n).min(1))
        if (now == label).all():
            break
        label = now
    want = []
    for a in range(n):
        ids = [rows[b][0] for b in range(n) if label[b] == label[a] and rows[b][0] is not None]
        component = min(ids) if ids else None
        want.append((rows[a][0], int(linked[a].sum()), component, rows[a][0] == component))
    assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == Counter(want)
    assert linked.sum() > 5000
    assert vectors.near_duplicates(table(spark, [])).count() == 0


def test_near_vectors_are_written_once_and_compared_beyond_single_precision(spark, monkeypatch):
    for name, value in (("CELL", 60), ("BLOCK", 32)):
        monkeypatch.setattr(vectors, name, value)
    folders = []
    monkeypatch.setattr(vectors, "scratch", lambda *at: folders.append(scratch(*at)) or folders[-1], raising=False)
    rng = np.random.default_rng(11)
    base = rng.normal(size=(700, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.normal(size=base.shape)
    side -= (side * base).sum(1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = 0.93 + rng.choice([-1e-9, 1e-9, -1e-7, 1e-7, -0.02, 0.05], size=(700, 1))
    points = np.concatenate([base, cosine * base + np.sqrt(1 - cosine**2) * side])  # without clusters, half of the links near the bound
    rows = [(i, p.tolist(), int(i % 700 % 8 == 0)) for i, p in enumerate(points)]
    got = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    label = np.array([r[2] for r in rows])
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.93) & (label[:, None] == label[None, :])
    assert {r.vec_id: r.n_links for r in got} == dict(enumerate((linked.sum(1) - 1).tolist()))
    assert all(r.kept == (r.vec_id == r.component_id) for r in got) and 300 < linked.sum() - 1400 < 1400
    files = [f for at in folders for f in Path(at.removeprefix("file:")).rglob("*.arrow")]
    sizes = [pa.ipc.open_file(str(f)).read_all().num_rows for f in files]
    assert sum(sizes) == 1400 and max(sizes) <= 16 * 32  # no copies for the cells in which they are guests


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(200, 200), (301, 300), (300, 301), (-5, 100)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {i: -5 for i in [-5, *range(100, 140)]} | {300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


PAGES = "page_id long, url string, html string, payload string, sha1 int, package string"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://a/{i}?q=é\r\nx", f"<p>{i % 7} ü</p>" * (1 + i % 7)) for i in range(40)]
    rows += [(50, None, None), (51, "u", ""), (52, "u", "a" * 300_000), (None, "u", "<p>5 ü</p>"), (60, "u", "twice"), (60, "u", "twice")]
    return rows, spark.createDataFrame([(*r, "x", 1, "y") for r in rows], PAGES)


def test_archives_give_back_every_page(pages):
    rows, df = pages
    got = warczip.round_trip(df).collect()
    largest = {}
    for i, _, html in rows:
        html = html or ""
        largest[html] = max(largest.get(html, -1), -1 if i is None else i)
    want = Counter()
    for i, _, html in rows:
        raw = (html or "").encode()
        first = largest[html or ""]
        kind = ("response", None) if i == first or first == -1 else ("revisit", first)
        want[(i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), *kind)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    for r in got:
        assert (r.payload is None) == (r.record_type == "revisit")
    assert warczip.round_trip(df.where("false")).count() == 0


def test_small_payloads_need_not_be_revisits(pages):
    _, df = pages
    rows = warczip.round_trip(df, least_bytes=20).collect()
    assert all(r.record_type == "response" for r in rows if r.payload_bytes < 20) and any(r.record_type == "revisit" for r in rows)


def test_packages_are_zip_files(spark, pages, tmp_path):
    _, df = pages
    folder = scratch(spark, "archives")
    found = warczip.write_packages(warczip.typed(df), folder, most_bytes=2000).collect()
    assert len(found) > 2 and sum(r.records for r in found) == df.count()
    with zipfile.ZipFile(found[0].package) as z:
        assert z.testzip() is None and sorted(z.namelist()) == ["archive/data.warc.gz", "indexes/index.cdxj"]
        assert all(i.compress_type == zipfile.ZIP_STORED for i in z.infolist())


class Raw:
    """A file in memory, read as an Arrow file is."""

    def __init__(self, data):
        self.data = data

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        return self.data[at : at + n]


@pytest.mark.parametrize("zip64", [False, True])
def test_directories_of_other_writers(zip64):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in (("a.txt", b"one"), ("archive/data.warc.gz", b"two" * 50)):
            with z.open(zipfile.ZipInfo(name), "w", force_zip64=zip64) as f:
                f.write(data)
        z.comment = b"a note at the end"
    file = Raw(out.getvalue())
    members = {m.name: m for m in warczip.directory(file)}
    at = warczip.data_start(file, members["archive/data.warc.gz"])
    assert file.data[at : at + 150] == b"two" * 50 and members["a.txt"].size == 3


def test_broken_archives_are_errors():
    with pytest.raises(ValueError):
        warczip.directory(Raw(b"no archive"))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/data.warc.gz", b"x" * 100)
    file = Raw(out.getvalue())
    with pytest.raises(ValueError):
        warczip.data_start(file, warczip.directory(file)[0])
