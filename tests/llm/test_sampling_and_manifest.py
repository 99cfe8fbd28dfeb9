"""Importance resampling, source mixing and the Merkle manifest against plain Python, on awkward input."""
import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from rttlab.llm import importance, merkle, mixing, order

random.seed(21)
VOCABULARY = ["Alpha", "beta", "gämma", "7", "x", "DELTA", "é", "long" * 30]
LONG = " ".join(random.choices(VOCABULARY, k=150_000))
TEXTS = [None, "", " \t\n", "one", "A-b c", "a  b\tc", "same text", "same text", LONG, "z" * 70_000, "\x00nul\x00", "É é İ"]
TEXTS += [" ".join(random.choices(VOCABULARY, k=random.randint(10, 60))) for _ in range(60)]
SOURCES = ["s1", "s0", None, "é", "S", ""]
LANGS = ["en", None, "de", "", "é", "once"]
ROWS = [(i, t, LANGS[0] if i % 3 else LANGS[i % 5], SOURCES[i * i % 6 if i % 2 else 0], None if i % 7 == 0 else i, "clash")
        for i, t in enumerate(TEXTS)] + [(None, "no id", "once", "s0", 1, None), (6, "same text", "en", "s1", 6, "clash")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, {} string"


def table(spark, clash="score", rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA.format(clash)).repartition(5)


def words(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def buckets(t):
    w = words(t)
    return [zlib.crc32(f.encode()) % 10_000 for f in w + [a + " " + b for a, b in itertools.pairwise(w)]]


def want_scores(rows, target):
    s, t = (collections.Counter(itertools.chain.from_iterable(map(buckets, x))) for x in ([r[1] for r in rows], target))
    ss, tt = sum(s.values()), sum(t.values())
    out = []
    for i, text, *_ in rows:
        b = buckets(text)
        g = [math.floor(1000 * math.log((t[x] + 1) * (ss + 10_000) / ((s[x] + 1) * (tt + 10_000)))) for x in b]
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(g) // len(g) if g else 0
        out.append((i, len(words(text)), len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))))
    return out


@pytest.mark.parametrize("chunk", [1 << 16, 7])
def test_importance(spark, monkeypatch, chunk):
    monkeypatch.setattr(importance, "CHUNK_WORDS", chunk)  # in this process only; the direct call below sees it
    texts = [(t or "").encode() for t in TEXTS]
    for runs in (1, 2, 3):
        got = [collections.Counter() for _ in texts]
        for _, values, docs in importance.features(texts, runs):
            for v, d in zip(values.tolist(), docs.tolist(), strict=True):
                got[d][v] += 1
        for t, g in zip(TEXTS, got, strict=True):
            w = words(t)
            grams = [" ".join(w[i:i + k]) for k in range(1, runs + 1) for i in range(len(w) - k + 1)]
            assert g == collections.Counter(zlib.crc32(x.encode()) % 10_000 for x in grams)


def test_importance_scores_and_draw(spark):
    target = ["beta 7", None, "", "gämma gämma x"]
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    want = sorted(want_scores(ROWS, target), key=str)
    scores = importance.importance_scores(table(spark), goal)
    assert sorted(map(tuple, scores.collect()), key=str) == want
    best = sorted((r for r in want if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = {r.doc_id: r["rank"] for r in importance.draw(scores).collect() if r["rank"]}
    assert drawn == {r[0]: k for k, r in enumerate(best[:25 * len(best) // 100], 1)} and len(drawn) > 5
    rows = importance.importance_resample(table(spark, "row_hash"), goal)
    assert rows.columns == table(spark, "row_hash").columns
    assert sorted(r.doc_id for r in rows.collect()) == sorted(drawn)
    none = table(spark).limit(0)
    assert importance.draw(importance.importance_scores(none, goal.limit(0))).count() == 0


def test_draw_ranks_ties_and_repeated_rows(spark):
    rows = [(i % 50 or None, 20 + i % 3, i % 4) for i in range(400)] + [(7, 25, 3)] * 200
    scores = spark.createDataFrame(rows, "doc_id long, n_words long, score long").repartition(7)
    got = sorted((r["rank"], r.score, r.doc_id) for r in importance.draw(scores, percent=50).collect() if r["rank"])
    want = sorted(rows, key=lambda r: (-r[2], r[0] is None, r[0] or 0))[:300]
    assert got == [(k, s, i) for k, (i, _, s) in enumerate(want, 1)]


def test_positions_of_a_group_that_holds_most_rows(spark):
    rows = [("hot" if i % 10 else None, (i * 7919) % 5000) for i in range(5000)]
    got = order.positions(spark.createDataFrame(rows, "g string, v long"), ["g"], [F.col("v")]).collect()
    for g in ("hot", None):
        mine = sorted((r.position, r.v, r.group_rows) for r in got if r.g == g)
        assert [p for p, _, _ in mine] == list(range(len(mine))) and [v for _, v, _ in mine] == sorted(v for x, v in rows if x == g)
        assert {n for _, _, n in mine} == {len(mine)}


def test_targets():
    assert mixing.source_targets({"a": 100, "b": 100, "c": 100}) == {"a": (1500, 8), "b": (600, 8), "c": (300, 8)}
    got = mixing.source_targets({"a": 10, "b": 500, None: 90, "c": 0})  # weights 5, 2, 1, 5: a and c are capped
    assert {s: n / d for s, (n, d) in got.items()} == {"a": 30, "c": 0, "b": 300, None: 270}
    assert mixing.source_targets({}) == {} and mixing.source_targets({"a": 0}) == {"a": (0, 5)}
    assert mixing.source_targets({"é": 9, "z": 9, None: 9}, (3, 2, 1)) == {"z": (81, 6), "é": (54, 6), None: (27, 6)}


def cheapest(capacity, members, quota, repeats):
    """(words routed, cost) of the best routing, by trying all."""
    arcs = [(p, s) for p in members for s in members[p]]
    best = (0, 0)
    for amounts in itertools.product(*[range(min(repeats * capacity[p], quota[s]) + 1) for p, s in arcs]):
        used, got = collections.Counter(), collections.Counter()
        for (p, s), x in zip(arcs, amounts, strict=True):
            used[p] += x
            got[s] += x
        if any(used[p] > repeats * capacity[p] for p in members) or any(got[s] > quota[s] for s in quota):
            continue
        cost = sum(mixing.repetition_cost(c) * max(0, min(capacity[p], used[p] - c * capacity[p])) for p in members for c in range(repeats))
        best = min(best, (-sum(amounts), cost))
    return -best[0], best[1]


def test_flow_is_the_largest_and_cheapest():
    rng = random.Random(3)
    for _ in range(60):
        members = {p: rng.sample(["x", "y", None], rng.randint(1, 2)) for p in range(rng.randint(1, 3))}
        capacity = {p: rng.randint(0, 3) for p in members}
        quota = {s: rng.randint(0, 4) for s in ("x", "y", None)}
        flow = mixing.route(capacity, members, quota, 2)
        used, got = collections.Counter(), collections.Counter()
        for (p, s), x in flow.items():
            assert x > 0 and s in members[p]
            used[p] += x
            got[s] += x
        assert all(used[p] <= 2 * capacity[p] for p in members) and all(got[s] <= quota[s] for s in quota)
        cost = sum(mixing.repetition_cost(c) * max(0, min(capacity[p], used[p] - c * capacity[p])) for p in members for c in range(2))
        assert (sum(flow.values()), cost) == cheapest(capacity, members, quota, 2)


def size(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def test_mixing_disjoint_sources(spark):
    mix = mixing.mix_sources(table(spark, "taken"), F.array("source"))
    got = collections.Counter((r.doc_id, r["members"][0], r.size, r.taken) for r in mix.documents.collect())
    assert sum(got.values()) == len(ROWS)
    assert collections.Counter((i, s, n) for (i, s, n, _), c in got.items() for _ in range(c)) == collections.Counter(
        (i, s, size(t)) for i, t, _, s, *_ in ROWS)
    taken = collections.Counter()
    for (_, s, n, x), c in got.items():
        assert 0 <= x <= 3 * n
        taken[s] += x * c
    for r in mix.sources.collect():
        assert r.source_size == sum(size(t) for _, t, _, s, *_ in ROWS if s == r.source)
        assert taken[r.source] == r.routed == math.floor(r.target)
    again = mixing.mix_sources(table(spark, "taken", ROWS[::-1]), F.array("source"))
    assert got == collections.Counter((r.doc_id, r["members"][0], r.size, r.taken) for r in again.documents.collect())
    empty = mixing.mix_sources(table(spark).limit(0), F.array("source"))
    assert empty.documents.count() == 0 and empty.sources.count() == 0


def test_mixing_overlapping_sources(spark):
    rng = random.Random(8)
    rows = [(i, " w" * rng.randint(0, 30), sorted(rng.sample(["a", "b", "c"], rng.randint(0, 3)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, of array<string>")
    mix = mixing.mix_sources(docs, F.col("of"))
    out = mix.documents.collect()
    flows = collections.Counter()
    for r in mix.flows.collect():
        assert r.source in r["members"]
        flows[tuple(r["members"])] += r.words
    taken = collections.Counter()
    for r in out:
        assert 0 <= r.taken <= 3 * r.size
        taken[tuple(r["members"])] += r.taken
    assert +taken == +flows and taken[()] == 0
    assert {r.source: r.routed for r in mix.sources.collect()} == {r.source: math.floor(r.target) for r in mix.sources.collect()}
    with pytest.raises(ValueError):
        mixing.mix_sources(docs, F.col("of"), max_patterns=3)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def encode(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes, fanout=8):
    """(root, siblings of every leaf as (left, right) per level)"""
    paths, levels = [[] for _ in nodes], nodes
    at = list(range(len(nodes)))
    while len(levels) > 1:
        for k, a in enumerate(at):
            run = levels[a // fanout * fanout:a // fanout * fanout + fanout]
            paths[k].append(("".join(run[:a % fanout]), "".join(run[a % fanout + 1:])))
        levels = [sha("".join(levels[i:i + fanout])) for i in range(0, len(levels), fanout)]
        at = [a // fanout for a in at]
    return levels[0], paths


def want_manifest(rows):
    lower = lambda t: t and re.sub("[A-Z]", lambda m: m[0].lower(), t)
    leaf = lambda i, t, lang, s, n: sha("".join(map(encode, (i, s, lang, n, t))))
    groups = collections.defaultdict(list)
    for i, t, lang, s, n, *_ in rows:
        hit = i is not None and zlib.crc32(str(i).encode()) % 3 == 0
        groups[lang].append((i, leaf(i, t, lang, s, n), leaf(i, lower(t) if hit else t, lang, s, n)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    below = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        below[g] = tree([r[1] for r in groups[g]])
    root, above = tree([below[g][0] for g in names])
    out = collections.Counter()
    for g, up in zip(names, above, strict=True):
        for (i, original, seen), path in zip(groups[g], below[g][1], strict=True):
            path = path + up
            own = seen
            for left, right in path:
                own = sha(left + own + right)
            out[i, original, below[g][0], root, sha("".join(a + b for a, b in path)), own, own == root] += 1
    return out


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], [(i, f"T{i}", f"l{i % 70}", None, i, None) for i in range(600)],
                                  [(i, f"T{i}", "en", "s", i, None) for i in range(65)]], ids=["mixed", "one", "many groups", "one group"])
def test_manifest(spark, rows):
    docs = table(spark, "pos", rows)
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lower = F.when(hit, F.translate("text", merkle.UPPER, merkle.LOWER)).otherwise(F.col("text"))
    out = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], tampered={"text": lower})
    got = collections.Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in out.collect())
    assert got == want_manifest(rows)
    assert merkle.manifest(docs.limit(0), ["doc_id", "text"]).count() == 0
