"""run() of the corpus pipeline on a small table, stage by stage against plain Python."""
import collections
import random
import re

import pytest
import xxhash

import corpus_pipeline
from rttlab.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def again(items, n):
    """Positions inside an n-gram that occurred earlier, and inside one that occurs twice or more."""
    grams = [tuple(items[k:k + n]) for k in range(len(items) - n + 1)]
    count, seen, later, twice = collections.Counter(grams), set(), set(), set()
    for k, g in enumerate(grams):
        later |= set(range(k, k + n)) if g in seen else set()
        twice |= set(range(k, k + n)) if count[g] > 1 else set()
        seen.add(g)
    return later, twice


def good(text):
    w = WORD.findall(text or "")
    if len(w) < 50 or 100 * len(again(w, 3)[1]) > 50 * len(w):
        return False
    for n, limit in {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}.items():
        if sum(len(w[k]) for k in again(w, n)[0]) > limit * sum(map(len, w)):
            return False
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return sum(len(lines[k]) for k in again(lines, 1)[0]) <= 0.2 * sum(map(len, lines))


def fingerprint(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[k:k + 3]).encode(), 42) for k in range(len(w) - 2)]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def near(docs):
    prints, root = {i: fingerprint(t) for i, t in docs.items()}, {i: i for i in docs}
    for a in sorted(docs):
        for b in sorted(docs):
            if bin(prints[a] ^ prints[b]).count("1") <= simhash.MAX_BITS and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    return {i: t for i, t in docs.items() if root[i] == i}


def test_every_stage(spark, tmp_path, monkeypatch):
    tiktoken, public = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    from rttlab.llm import bpe
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe.read_ranks(public.path("byte_bpe_50k.tiktoken")), special_tokens={})
    rng = random.Random(12)
    fresh = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    base, passage, sentence = fresh(400), fresh(40), fresh(12)
    texts = [None, "", fresh(49), fresh(50), base, base.replace(" ", "  ", 3), base + " end", base + "\nEnd here", fresh(60) + " " + passage + " " + fresh(60),
             passage + " " + fresh(70), fresh(80) + "\n" + passage, " ".join([sentence] * 6), fresh(40) + "\n" + "\n".join([sentence] * 3), fresh(3000), fresh(90)]
    rows = [(i, t, "en", "web", len(t or "")) for i, t in enumerate(texts)]
    (spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
     .write.parquet(str(tmp_path / "documents.parquet")))

    seen, keep = {}, corpus_pipeline.persist_table

    def watched(df, name):
        seen[name] = out = keep(df, name)
        return out

    monkeypatch.setattr(corpus_pipeline, "persist_table", watched)
    places = corpus_pipeline.run(spark, str(tmp_path)).collect()
    got = [{r.doc_id: r.text for r in seen["pipeline-" + n].collect()} for n in ("quality-rules", "exact-dedup", "simhash-near-dedup", "substring-dedup")]

    want = {i: t for i, t in enumerate(texts) if good(t)}
    assert got[0] == want and len(want) < len(texts) - 3
    firsts = {}
    for i, t in sorted(want.items()):
        firsts.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), i)
    exact = {i: want[i] for i in firsts.values()}
    assert got[1] == exact and len(exact) < len(want)
    unlike = near(exact)
    assert got[2] == unlike and len(unlike) < len(exact)
    words = {i: WORD.findall(t) for i, t in unlike.items()}
    count = collections.Counter(tuple(w[k:k + 35]) for w in words.values() for k in range(len(w) - 34))
    rest = {}
    for i, w in words.items():
        gone = {k + j for k in range(len(w) - 34) if count[tuple(w[k:k + 35])] > 1 for j in range(35)}
        rest[i] = [x for k, x in enumerate(w) if k not in gone]
    assert {i: WORD.findall(t) for i, t in got[3].items()} == rest and rest != words
    assert all(r.n_chars == len(r.text) for r in seen["pipeline-substring-dedup"].collect())

    tokens, full = collections.Counter(), collections.defaultdict(list)
    for r in places:
        tokens[r.doc_id] += r.length
        full[r.sequence_id].append((r.offset, r.length))
    assert tokens == {i: len(library.encode_ordinary(t)) + 1 for i, t in got[3].items()}
    for spans in full.values():
        spans.sort()
        assert [a for a, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))] and sum(n for _, n in spans) <= 2048


CLASHING = ["kept", "n_words", "n_removed", "base_failed", "_row", "_hash", "_id", "_whole", "_tag", "rest", "id", "row_hash", "fp", "root",
            "component_id", "fingerprint", "digest", "locator", "spans", "whole", "norm", "dup_chars_5", "piece", "length"]


@pytest.mark.parametrize("empty", [False, True])
def test_stages_return_every_column_as_it_came(spark, tmp_path, empty):
    rng = random.Random(3)
    fresh = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    base, passage = fresh(300), fresh(45)
    texts = [base, base, fresh(60) + " " + passage, passage + " " + fresh(70), None, "", fresh(20)]
    rows = [(i if i != 2 else None, t, *[f"mine {i} {c}" for c in CLASHING], i * 7) for i, t in enumerate(texts)]
    rows += [rows[0], rows[2], (None, None, *[None] * len(CLASHING), None)] * 2
    docs = spark.createDataFrame(rows if not empty else [], "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHING) + ", n_chars long")
    inputs = collections.Counter((r.doc_id, *[r[c] for c in CLASHING]) for r in docs.collect())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        got = collections.Counter((r.doc_id, *[r[c] for c in CLASHING]) for r in out.collect())
        assert got <= inputs and bool(got) != empty, name
        if name == "exact dedup":
            assert max(got.values(), default=1) == 1
    places = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert len({(r.doc_id, r.piece) for r in places}) == (0 if empty else len({r[0] for r in rows}))
