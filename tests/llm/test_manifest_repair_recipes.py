"""Manifest, repair of conversations and exact duplicates against brute force, and in the cases that tables are not tidy."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.llm import auditpaths, merkle, midstates, recipes, repair, suite
from skyloom.tables import table

SPACES = re.compile(r"[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


# Manifest


def plain_leaf(row, text):
    return sha("".join(framed(v) for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)))


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def plain_manifest(rows):
    """Count of (doc_id, leaf, subroot, root, proof, folded root, verified) by the definition, row by row."""
    sources = defaultdict(list)
    for row in rows:
        text = row["text"]
        odd = row["doc_id"] is not None and text is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0
        offered = plain_leaf(row, text.replace("\n", "") if odd else text)
        sources[row["source"]].append((row["doc_id"] is not None, row["doc_id"] or 0, plain_leaf(row, text), offered))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        sources[name].sort()
        trees.append(plain_levels([leaf for _, _, leaf, _ in sources[name]]))
    top = plain_levels([levels[-1][0] for levels in trees])
    found = Counter()
    for s, name in enumerate(names):
        for i, (real, doc_id, leaf, offered) in enumerate(sources[name]):
            proof, folded = [], offered
            for levels, at in ((trees[s], i), (top, s)):
                for level in levels[:-1]:
                    run = level[at // 3 * 3 : at // 3 * 3 + 3]
                    proof += run[: at % 3] + run[at % 3 + 1 :]
                    folded = sha("".join([*run[: at % 3], folded, *run[at % 3 + 1 :]]))
                    at //= 3
            found[doc_id if real else None, leaf, trees[s][-1][0], top[-1][0], sha("".join(proof)), folded, folded == top[-1][0]] += 1
    return found


def offered(rows):
    return F.when(F.crc32(rows.doc_id.cast("string")) % 2 == 0, F.replace(rows.text, F.lit("\n"), F.lit(""))).otherwise(rows.text)


def found_manifest(rows):
    got = merkle.manifest(rows, offered(rows)).collect()
    return Counter(
        (r.doc_id, *(bytes(d).hex() for d in (r.leaf, r.subroot, r.root, r.proof, r.folded)), r.folded == r.root) for r in got
    )


def test_states_are_those_of_sha256():
    rng = np.random.default_rng(2)
    digests = rng.integers(0, 1 << 32, (5, 8), dtype=np.uint64).astype(np.uint32)
    texts = [bytes(d).hex() for d in midstates.to_bytes(digests)]
    state = midstates.start(5)
    for k in range(4):
        closed = midstates.to_bytes(midstates.finish(state, np.full(5, k)))
        assert [bytes(d).hex() for d in closed] == [sha(t * k) for t in texts]
        state = midstates.step(state, midstates.hex_blocks(digests))


def test_manifest_query(spark, folder):
    rows = [r.asDict() for r in table(spark, folder, "documents").collect()]
    got = suite.QUERIES["op11_midstate_manifest"](spark, folder)
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(tuple(r) for r in got.select(*names).collect()) == plain_manifest(rows)
    assert 0 < got.where("verified").count() < len(rows)


def test_manifest_of_odd_rows(docs, prose):
    rows = docs([*prose, (500, "a\nb", "ß"), (501, "a\nb", "zz"), (501, "a\nb", "zz"), (501, "c", "zz")])
    assert found_manifest(rows) == plain_manifest([r.asDict() for r in rows.collect()])


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4])
def test_small_manifests(docs, n):
    rows = docs([(i, f"x\n{i}", "s") for i in range(n)])
    assert found_manifest(rows) == plain_manifest([r.asDict() for r in rows.collect()])


def test_manifest_of_many_blocks(spark, docs, monkeypatch):
    """One source holds most rows, and another one is a single block; with small blocks there are four passes."""
    rows = docs([(i, f"x\n{i}", "s" if i % 9 else "t") for i in range(1500)])
    want = plain_manifest([r.asDict() for r in rows.collect()])
    assert found_manifest(rows) == want
    monkeypatch.setattr(merkle, "HEIGHT", 2)
    monkeypatch.setattr(merkle, "BLOCK", 9)
    monkeypatch.setattr(merkle, "AT_ONCE", 50)
    assert found_manifest(rows) == want


# Repair


def plain_damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(conv_id, turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


def plain_repair(turns):
    """By the shortest path over (cost, audit) in a heap, which holds the rows it has made."""
    turns = [(turn, " " if role is None else role, " " if text is None else text) for turn, role, text in turns]
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], sha(t[2])))
    seen, faults = set(), []
    for _, role, text in turns:
        bare = text.strip(" \t\n\x0b\f\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    heap, done, made = [(0, "", 0, "", ())], set(), None
    while made is None:
        cost, audit, i, out, said = heapq.heappop(heap)
        if (i, out) in done:
            continue
        done.add((i, out))
        if i == len(turns) and out in ("", "a"):
            made = cost, audit, said
            break
        due = "assistant" if out == "u" else "user"
        if len(said) < 2 * len(turns) + 4:
            heapq.heappush(heap, (cost + 5, audit + "I", i, due[0], (*said, f"{due}:")))
        if i < len(turns):
            _, role, text = turns[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, out, said))
            if faults[i] in ("", "truncated"):
                more = 5 * (faults[i] == "truncated")
                heapq.heappush(heap, (cost + more + 1, audit + "R", i + 1, due[0], (*said, f"{due}:{text}")))
                if role[:1] == due[0] or (role[:1] == "s" and out == ""):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[0], (*said, f"{role}:{text}")))
    numbers = {t[0] for t in turns if t[0] is not None}
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:], strict=False)]
    return (
        max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs), made[0], made[1], sha("\n".join(made[2])), made[2],
    )


def plain_repairs(rows, every):
    held = defaultdict(list)
    for conv_id, *turn in rows:
        held[conv_id].append(tuple(turn))
    return {c: plain_repair(held[c]) for c in {r[0] for r in every}}


CONVERSATIONS = "conv_id long, turn long, role string, text string, at long, of string, ord string, symbols long, last string"


def talks(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y", 2, "z") for r in rows], CONVERSATIONS)


def some_talks(n, most, seed=4):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        length = rng.randint(1, most)
        for i in range(length):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "usher", ""]) if rng.random() < 0.6 else ("user", "assistant")[i % 2]
            text = rng.choice([f"Say {rng.randint(0, 9)}.", f"Well {rng.random()}!", "cut off", "", " \n", "Why? \t", "a.b"])
            rows.append((c, i + rng.choice([0, 0, 0, 3]), role, text))
    return rows


ODD = [(None, None, None, None), (None, 1, "user", "A."), (None, None, "user", "A."), (7001, None, "assistant", None), (7002, 5, "user", "Ü" * 5000 + "."),
       (7003, 1, "user", "x."), (7003, 1, "assistant", "y."), (7003, 1, "user", "x."), (7004, -9, "system", "Only."), (7005, 2, None, "no role.")]


@pytest.mark.parametrize("bits", [12, 1])
def test_repairs_of_odd_rows(spark, bits):
    rows = some_talks(80, 9) + some_talks(1, 60, 8) + ODD
    every = [*rows, (8000, 1, "user", "gone")]
    got = repair.repairs(talks(spark, rows), talks(spark, every), bits).collect()
    want = plain_repairs(rows, every)
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r.conv_id][:-1], r
    lines = defaultdict(list)
    for r in repair.repaired(talks(spark, rows), bits).orderBy("conv_id", "place").collect():
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    assert {c: tuple(v) for c, v in lines.items()} == {c: w[-1] for c, w in want.items() if w[-1]}


def test_repair_query(spark, folder):
    rows = [tuple(r) for r in table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
    want = plain_repairs(plain_damage(rows), rows)
    got = suite.QUERIES["op12_ranked_repair"](spark, folder).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == {c: w[:-1] for c, w in want.items()} and len(got) == len(want)


def test_damage_of_odd_rows(spark):
    rows = some_talks(60, 9) + ODD
    assert Counter(tuple(r) for r in repair.damaged(talks(spark, rows)).collect()) == Counter(plain_damage(rows))


def test_no_conversations(spark):
    assert repair.repairs(talks(spark, ODD).where("false")).collect() == []
    only = repair.repairs(talks(spark, ODD).where("false"), talks(spark, [(1, 1, "user", "a")])).collect()
    assert [tuple(r) for r in only] == [(1, 0, 0, 0, 0, 0, 0, "", sha(""))]


def test_ranks_order_audits():
    """Ranks of nodes are in the order of their whole audits, an ended one first."""
    words = [bytes(97 + random.Random(i).choice([0, 4, 8, 12, 5, 9, 6, 7]) for _ in range(7)) for i in range(40)]
    symbols, first = auditpaths.aligned(words)
    end = np.tile(auditpaths.AT_END, (40, 1))
    heads, there = auditpaths._optimal_arcs(symbols, auditpaths.costs_to_go(symbols, end), np.ones(40, bool))
    rank = auditpaths._ranks(heads, there)
    begin = np.tile(np.arange(4), (40, 1))
    texts, _ = auditpaths.audits(words, end, np.ones(40, bool), begin)
    nodes = [(texts[w][s], rank[(first[w] * 40 + w) * 4 + s]) for w in range(40) for s in range(4)]
    assert [t for t, _ in sorted(nodes)] == [t for t, _ in sorted(nodes, key=lambda n: n[1])]
    assert len({t for t, _ in nodes}) == len({r for _, r in nodes})


# Exact duplicates


def plain_groups(rows):
    texts = [SPACES.sub(" ", t or "") for _, t, _ in rows]
    groups = defaultdict(list)
    for (i, _, _), t in zip(rows, texts, strict=True):
        groups[t].append(i)
    least = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    found = Counter((i, least[t], len(groups[t]), sha(t)) for (i, _, _), t in zip(rows, texts, strict=True))
    return found, len(groups)


@pytest.mark.parametrize(("bits", "least", "most"), [(64, 1024, 8192), (10, 64, 256), (64, 4, 9)])
def test_duplicates_of_odd_rows(docs, prose, bits, least, most):
    """Also with identifiers of 20 bits, of which the first seeds make some meet."""
    spaced = [(600 + i, (t or "").replace(" ", " \t\n") + "  ", "s") for i, t, _ in prose[:40] if i is not None]
    rows = [*prose, *spaced, *[(700 + i, t and t + "  ", "s") for i, (_, t, _) in enumerate(prose[:40])]]
    got = recipes.duplicates(docs(rows), bits, least, most).collect()
    want, groups = plain_groups(rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == groups
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_identifiers_that_meet_are_found(docs, prose):
    texts = docs(prose[:60]).select(recipes.normalised(F.col("text")).alias("normal"))
    assert recipes.verified_seed(texts, 7, least=64, most=256) > 0
    with pytest.raises(ValueError, match="collision"):
        recipes.verified_seed(texts, 2, tries=3, least=64, most=256)


def test_chunks_are_the_text(docs, prose):
    rows = docs(prose).select(recipes.normalised(F.col("text")).alias("t"))
    for r in rows.withColumn("c", recipes.chunks(F.col("t"), 16, 64)).collect():
        assert "".join(r.c) == r.t and all(0 < len(c) <= 64 for c in r.c)


def test_chunks_meet_again_after_a_change(spark):
    words = [str(i) + random.Random(i).choice(["ab", "cd.", "efg", "h,"]) for i in range(3000)]
    rows = spark.createDataFrame([(" ".join(words),), ("New start. " + " ".join(words),)], "t string")
    one, two = (set(r[0]) for r in rows.select(recipes.chunks(F.col("t"), 128, 1024)).collect())
    assert len(one & two) > 0.5 * len(one)


def test_no_documents(docs):
    assert recipes.duplicates(docs([])).collect() == []
