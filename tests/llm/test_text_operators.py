"""Text operators against brute force, and in the cases that tables are not tidy."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from skyloom.llm import mixing, neardup, packing, quality, repeats, sharding, suite, templates

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def as_set(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()


@pytest.mark.parametrize("name", [n for n in suite.ORACLES if n != "op9_pivot_top_k"])
def test_queries_equal_sql(spark, folder, name):
    ok, note, _ = compare(spark, duck(folder), folder, name, suite.QUERIES[name], suite.ORACLES[name])
    assert ok, note


def plain_mix(rows, share=1.5, most=2.0):
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(n for n, r in zip(size, rows, strict=True) if r[2] == s) for s in names}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, free, target = share * sum(total.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if level * weight[s] > most * total[s]}
        if not above:
            target |= {s: level * weight[s] for s in free}
            break
        for s in above:
            target[s] = most * total[s]
            left -= target[s]
        free -= above
    return total, target


def test_mix_reaches_targets(docs, prose):
    found = mixing.mix(docs(prose)).collect()
    total, target = plain_mix(prose)
    taken = defaultdict(int)
    for r in found:
        taken[r.source] += r.taken
        assert r.size == len(WORD.findall(dict_text(prose, r.doc_id, r.size))) and 0 <= r.taken <= 2 * r.size
        assert r.source_size == total[r.source] and r.target == pytest.approx(target[r.source])
    assert len(found) == len(prose)
    assert {s: n for s, n in taken.items()} == {s: int(target[s] + 1e-9) for s in taken}
    again = mixing.mix(docs(list(reversed(prose)))).collect()
    assert Counter((r.doc_id, r.size, r.taken) for r in again) == Counter((r.doc_id, r.size, r.taken) for r in found)


def dict_text(rows, doc_id, size):
    return next(t or "" for i, t, _ in rows if i == doc_id and len(WORD.findall(t or "")) == size)


def test_mixed_rows_have_as_many_words(docs, prose):
    taken = {(r.source): r.n for r in mixing.mix(docs(prose)).groupBy("source").agg(F.sum("taken").alias("n")).collect()}
    table = docs(prose)
    rows = mixing.mixed_rows(table)
    assert rows.columns == table.columns
    words = defaultdict(int)
    whole = {t for _, t, _ in prose if t}
    cut = 0
    for r in rows.collect():
        words[r.source] += len(WORD.findall(r.text or ""))
        if r.text and r.text not in whole:
            cut += 1
            assert any(t.startswith(r.text) for t in whole)
    assert dict(words) == taken and 0 < cut <= 6


def test_mix_of_nothing_and_of_empty_texts(docs):
    assert mixing.mix(docs([])).count() == 0 and mixing.mixed_rows(docs([])).count() == 0
    rows = mixing.mix(docs([(1, None, "a"), (2, "", None)])).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2


def plain_repeats(rows, length):
    texts = [(i, (t or "").encode()) for i, t, _ in rows]
    count = Counter(b[k : k + length] for _, b in texts for k in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        runs = []
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                if runs and k <= runs[-1][1]:
                    runs[-1][1] = k + length
                else:
                    runs.append([k, k + length])
        kept, at = b"", 0
        for a, e in runs:
            kept, at = kept + b[at:a], e
        kept += b[at:]
        out.append((i, len(b), len(b) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("length", [40, 200])
def test_repeats_equal_brute_force(docs, prose, length):
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefg h") for _ in range(450))
    rows = prose + [(500 + i, passage[: 150 + 40 * i] + str(i) * 20 + passage[i : 260 + i], "p") for i in range(8)]
    rows += [(600, passage[:199], "p"), (601, "x" * 199, "p"), (602, "y" * 200, "p"), (603, "z" * 201, "p"), (604, "ab" * 150, "p")]
    found = repeats.without_repeats(docs(rows), length).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == plain_repeats(rows, length)
    for r in found:
        assert sum(b - a for a, b in zip(r.starts, r.stops, strict=True)) == r.n_removed and len(r.kept) == r.n_bytes - r.n_removed


def test_repeats_of_nothing(docs):
    assert repeats.without_repeats(docs([])).count() == 0


def test_shards_are_near_equal_and_gapless(spark, docs, prose):
    rows = sharding.shard(docs(prose), 5, 1024).collect()
    texts = Counter((i, zlib.crc32((t or "").encode())) for i, t, _ in prose)
    assert Counter((r.doc_id, r.text_crc32) for r in rows) == texts
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    loads = [sum(r.size for r in part) for part in by.values()]
    assert len(loads) == 5 and max(loads) - min(loads) <= max(r.size for r in rows)
    assert {r.law for r in rows} == {"bytes"}
    assert sharding.shard(docs([])).count() == 0


def test_repeated_rows_spread_over_shards(docs):
    rows = [(None, "one text", "s")] * 9000 + [(i, f"text {i}", "s") for i in range(50)] + [(7, "text 7", "s")]
    found = sharding.shard(docs(rows)).collect()
    assert Counter((r.doc_id, r.size) for r in found) == Counter((i, len(t) + 16) for i, t, _ in rows)
    held = Counter(r.shard for r in found)
    assert len(held) == 40 and max(held.values()) < 1.05 * len(rows) / 40
    assert sorted((r.shard, r.slot) for r in found) == [(s, n) for s in sorted(held) for n in range(held[s])]


def test_a_grown_map_moves_slots_to_the_new_shard_only(spark, docs, prose):
    placed = sharding.records(docs(prose), 256)
    sizes = sharding.slot_sizes(placed)
    now = sharding.rebalanced(sharding.first_map(spark, 256, 4), sizes, 4)
    before = {r.virtual_slot: r.shard for r in now.collect()}
    after = {r.virtual_slot: (r.shard, r.version) for r in sharding.grown(now, sizes, 4).collect()}
    assert before.keys() == after.keys() == set(range(256))
    moved = {v for k, (v, _) in after.items() if v != before[k]}
    assert moved == {4} and {v for _, v in after.values()} == {2}


def plain_groups(rows, width, similarity):
    sets = [as_set(t, width) for _, t, _ in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both * similarity[1] >= similarity[0] * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    members = defaultdict(list)
    for i, (doc_id, _, _) in enumerate(rows):
        members[find(i)].append(doc_id)
    out = []
    for i, (doc_id, _, _) in enumerate(rows):
        ids = [x for x in members[find(i)] if x is not None]
        component = doc_id if not sets[i] else (min(ids) if ids else None)
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return Counter(out), members


@pytest.mark.parametrize(("width", "similarity"), [(3, (85, 100)), (5, (80, 100))])
def test_near_duplicates_equal_brute_force(docs, prose, width, similarity):
    found = neardup.near_duplicates(docs(prose), width, similarity).collect()
    want, members = plain_groups(prose, width, similarity)
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == want
    assert max(map(len, members.values())) > 30


def test_one_of_each_group_stays(docs, prose):
    table = docs(prose)
    kept = neardup.one_of_each(table, 3, (85, 100))
    assert kept.columns == table.columns
    _, members = plain_groups(prose, 3, (85, 100))
    bare = sum(not as_set(t, 3) for _, t, _ in prose)
    full = {k for k in members if as_set(prose[k][1], 3)}
    assert kept.count() == len(full) + bare
    assert neardup.one_of_each(docs([])).count() == 0 and neardup.near_duplicates(docs([])).count() == 0


def test_repeated_rows_have_one_set(docs):
    text = " ".join(f"w{i}" for i in range(30))
    table = docs([(1, text, "s")] * 40 + [(None, text, "s")] * 40 + [(2, text + " more", "s")])
    nodes = neardup._keyed(table).select(F.col("row_key").alias("node")).distinct()
    assert Counter(r.node for r in neardup._sets(table, nodes, 3).collect()) == Counter(r.node for r in nodes.collect())
    found = neardup.near_duplicates(table, 3, (85, 100)).collect()
    assert len(found) == 81 and {r.component_id for r in found} == {1}


def test_blocks_link_what_the_pivot_does_not(docs, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 8)
    rng = random.Random(1)
    words = [f"w{i}" for i in range(5000)]
    base = [rng.choice(words) for _ in range(120)]
    rows = []
    for i in range(90):
        text = list(base)
        for k in rng.sample(range(120), rng.randint(2, 8)):
            text[k] = rng.choice(words)
        rows.append((i, " ".join(text), "s"))
    found = neardup.near_duplicates(docs(rows), 3, (85, 100)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == plain_groups(rows, 3, (85, 100))[0]


def near_copies(n, seed, words=120, most=16):
    """One text, and near copies of it with 0 to ``most`` words changed, of which many pairs are not linked."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(words)]
    rows = []
    for i in range(n):
        text = list(base)
        for k in rng.sample(range(words), rng.randint(0, most)):
            text[k] = f"c{rng.randrange(10**9)}"
        rows.append((i, " ".join(text), "s"))
    return rows


@pytest.mark.parametrize(("most", "similarity"), [(4, (85, 100)), (16, (85, 100)), (16, (60, 100))])
def test_crowded_groups_lose_no_link(docs, monkeypatch, most, similarity):
    monkeypatch.setattr(neardup, "BLOCK", 12)
    rows = near_copies(120, 7, most=most)[1:] + [(500 + i, t, "s") for i, t, _ in near_copies(60, 8, words=40, most=6)]
    found = neardup.near_duplicates(docs(rows), 3, similarity).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == plain_groups(rows, 3, similarity)[0]


def test_differences_tell_how_sets_differ():
    rng = np.random.default_rng(3)
    usual = np.sort(rng.choice(10**6, 60, replace=False)).astype(np.uint64)
    codes = np.where(np.arange(60) % 3 > 0, -1 - rng.integers(0, 9, 60), rng.integers(2, 9, 60)).astype(np.int64)
    sets = [np.unique(np.concatenate([rng.choice(usual, rng.integers(52, 60), replace=False), rng.integers(0, 10**6, rng.integers(0, 5), dtype=np.uint64)])) for _ in range(80)]
    told = [neardup.differences(s, usual.tobytes() + codes.tobytes(), (80, 100)) for s in sets]
    linked = 0
    for i in range(80):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            link = 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both)
            linked += link
            assert link or told[i][0] + told[j][0] > 0
            if link and told[i][0] + told[j][0] > 0:
                at = {t: r for t, r in zip(told[i][1].tolist(), told[i][2].tolist(), strict=True)}
                first = next((t, r) for t, r in zip(told[j][1].tolist(), told[j][2].tolist(), strict=True) if t in at)
                assert told[j][0] <= at[first[0]] and told[i][0] <= first[1]
    assert linked > 20
    assert neardup.differences(sets[0], b"", (80, 100))[0] == 180 * len(sets[0]) - 20 * len(sets[0])


def test_rows_compared_grow_with_the_group(docs, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 32)
    by_group, counts = neardup._by_group, []

    def counted(rows, judge, schema):
        counts[-1] += rows.count()
        return by_group(rows, judge, schema)

    monkeypatch.setattr(neardup, "_by_group", counted)
    for n in (600, 1200):
        counts.append(0)
        assert neardup.near_duplicates(docs(near_copies(n, 9)), 3, (85, 100)).count() == n
    assert counts[1] <= 2.5 * counts[0]  # the stars of the pivots alone grow by 2.15; all pairs would grow by 4


def test_classifier_on_rows_it_never_saw(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = quality.classify(spark.read.parquet(f"{folder}/documents.parquet"), labels, most=2000)
    judged = rows.where("held_out").join(labels, "doc_id").select("score", "predicted", "quality").toPandas()
    assert (judged.predicted == judged.quality).mean() > 0.97
    rank = judged.score.rank()
    good = judged.quality == 1
    area = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert area > 0.99 and judged.score.between(0, 1).all()
    assert ((judged.predicted == 0) & good).sum() == 0


def test_classifier_never_learns_from_held_out_rows(spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(None, 1), (3, None), (4, 5)], "doc_id long, quality int")
    table = docs([(i, f"text {i}", "s") for i in range(50)])
    ids = {r.doc_id for r in quality.training_rows(table, labels, 1000).collect()}
    assert ids == {i for i in range(50) if zlib.crc32(str(i).encode()) % 5}
    held = {r.doc_id for r in quality.classify(table, labels).collect() if r.held_out}
    assert held == set(range(50)) - ids


def test_classifier_without_labels_or_rows(spark, docs, prose):
    none = spark.createDataFrame([], "doc_id long, quality int")
    scores = {r.score for r in quality.classify(docs(prose), none).collect()}
    assert scores == {0.5}
    assert quality.classify(docs([]), none).count() == 0
    table = docs(prose)
    assert quality.good_rows(table, none).columns == table.columns and quality.good_rows(table, none).count() == len(prose)


def test_lines_with_variable_fields_recur(docs):
    rng = random.Random(2)
    own = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(4000)]

    def body(n):
        return "\n".join(" ".join(rng.choice(own) for _ in range(12)) for _ in range(n))

    rows = [(i, body(3) + f"\nPage {i} of {i + 9} printed for {own[i]} today\n" + body(2), "s") for i in range(30)]
    copy = body(6)
    rows += [(100 + i, copy, "s") for i in range(25)]
    rows += [(200, None, "s"), (201, "", "s"), (202, "a b", "s"), (None, body(2), "s"), (203, "All rights reserved.", "s")]
    found = {r.doc_id: r for r in templates.without_recurring_lines(docs(rows)).select("row.doc_id", "kept_text", "n_lines", "n_dropped").collect()}
    for i in range(30):
        assert found[i].n_dropped == 1 and "printed" not in found[i].kept_text and found[i].n_lines == 6
    assert all(found[100 + i].n_dropped == 0 for i in range(25))  # whole copies are for near-dedup
    assert found[200].kept_text is None and found[200].n_lines == 0 and found[201].n_lines == 0
    assert found[203].n_dropped == 0
    table = docs(rows)
    clean = templates.cleaned(table)
    assert clean.columns == table.columns and clean.count() == len(rows)
    assert templates.cleaned(docs([])).count() == 0


def test_a_template_tree_keeps_lines_apart(docs):
    rng = random.Random(4)
    words = ["".join(rng.choice("klmnop") for _ in range(5)) for _ in range(3000)]
    rows = [(i, "the same three " + " ".join(rng.choice(words) for _ in range(9)), "s") for i in range(60)]
    kept = templates.without_recurring_lines(docs(rows)).where("n_dropped > 0").count()
    assert kept == 0  # too few tokens of these lines stay, so they have no template in common


def first_fit(lengths, size):
    room = []
    for length in sorted(lengths, reverse=True):
        place = next((i for i, r in enumerate(room) if r >= length), None)
        if place is None:
            room.append(size - length)
        else:
            room[place] -= length
    return len(room)


def test_pack_tokens_and_places(docs, prose):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(suite.TOKENIZER)
    rows = prose + [(700, "<|endoftext|> It's I'LL Été. ÉTÉ, 漢字 12,5 ...!! é ×. ΑΣ.", "s")]
    found = packing.pack(docs(rows), suite.TOKENIZER, 256).collect()
    want = Counter()
    for i, text, _ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for k, start in enumerate(range(0, len(ids), 256)):
            part = ids[start : start + 256]
            want[(i, k, start, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for part in bins.values():
        at = 0
        for offset, length in sorted(part):
            assert offset == at
            at += length
        assert at <= 256
    assert len(bins) <= first_fit([r.length for r in found], 256)
    assert packing.pack(docs([]), suite.TOKENIZER).count() == 0


def test_word_memory_that_is_emptied_changes_nothing(prose):
    texts = pa.array([t for _, t, _ in prose], pa.string())
    large, small = packing.WordTokens(suite.TOKENIZER), packing.WordTokens(suite.TOKENIZER, 50)
    for start in range(0, len(texts), 7):
        a, b = large.encode(texts.slice(start, 7), 1), small.encode(texts.slice(start, 7), 1)
        assert (a[0] == b[0]).all() and (a[1] == b[1]).all()


@pytest.mark.parametrize("seed", range(5))
def test_plans_use_every_piece_once(seed):
    rng = random.Random(seed)
    counts = Counter(min(100, int(rng.paretovariate(0.7))) for _ in range(rng.choice([1, 50, 3000])))
    used = Counter()
    for times, pattern in packing.plan(dict(counts), 100):
        assert times > 0 and sum(length * n for length, n in pattern) <= 100
        for length, n in pattern:
            used[length] += times * n
    assert used == counts


def test_two_replace_the_smallest():
    # 60 and 30 fill a bin of 100 greedily; 30 is then replaced by 22 and 18, which leave no gap.
    assert packing.plan({60: 1, 30: 1, 22: 1, 18: 1}, 100)[0] == (1, [(60, 1), (22, 1), (18, 1)])


def test_fit_is_that_of_a_dense_model():
    """Naive Bayes support vectors by matrices: the same ratios and margins of the same order, dual objective within a thousandth."""
    rng = random.Random(6)
    words = [[f"w{k}" for k in range(a, b)] for a, b in ((0, 60), (40, 100))]
    good = np.array([i % 3 > 0 for i in range(200)])
    texts = [" ".join(rng.choice(words[int(g)] if rng.random() < 0.8 else words[0] + words[1]) for _ in range(30)) for g in good]
    features, at = quality.indicators(pa.array(texts))
    rows = [features[a:b].astype(np.int32) for a, b in zip(at[:-1], at[1:], strict=True)]
    model = quality.fit(list(zip(rows, good.tolist(), strict=True)), rounds=3000, close=1e-6)

    learn = np.arange(200) % 5 != 4
    x = np.zeros((200, 1 << quality.BITS), np.float32)
    for i, row in enumerate(rows):
        x[i, row] = 1
    counts = [x[learn & (good == g)].sum(0) + 1.0 for g in (True, False)]
    ratio = np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())
    seen = np.flatnonzero(x.any(0))
    z = np.c_[x[:, seen] * ratio[seen], np.ones(200)]
    sign = np.where(good, 1.0, -1.0)
    q = (z[learn] * sign[learn, None]) @ (z[learn] * sign[learn, None]).T
    alpha = np.zeros(learn.sum())
    for _ in range(400):
        for i in range(len(alpha)):
            alpha[i] = min(max(alpha[i] - (q[i] @ alpha - 1) / q[i, i], 0), 1)
    dual = alpha.sum() - alpha @ q @ alpha / 2
    dense = z @ (z[learn].T @ (alpha * sign[learn]))
    margin = x @ model.weights + model.bias
    v = np.r_[model.weights[seen] / ratio[seen], model.bias]
    primal = v @ v / 2 + np.maximum(0, 1 - sign[learn] * (z[learn] @ v)).sum()
    assert dual <= primal + 1e-6 and primal - dual <= 1e-3 * abs(dual)
    assert np.corrcoef(np.argsort(np.argsort(dense)), np.argsort(np.argsort(margin)))[0, 1] > 0.99
    assert ((margin > 0) == good).mean() > 0.9


def test_fit_reads_as_far_as_its_bound():
    rows = [(np.arange(i % 7, i % 7 + 5, dtype=np.int32), i % 3 == 0) for i in range(40)]
    bounded, first, every = (quality.fit(r, most=m) for r, m in ((rows, 100), (rows[:20], 1000), (rows, 1000)))
    assert (bounded.bias, bounded.slope, bounded.shift) == (first.bias, first.slope, first.shift) != (every.bias, every.slope, every.shift)
