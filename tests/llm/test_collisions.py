"""Texts made to collide under polynomial hashes: two unlike Thue-Morse words of 2,048 letters."""
import collections
import random

import numpy as np
import pyarrow as pa
import pytest

from rttlab.llm import bpe, fmindex, packing, quality, spans, suffix


def thue_morse(n, a, b):
    return "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(n))


ONE, TWO = thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")


def test_the_words_collide():
    roll = spans.Rolling(11)
    data = np.frombuffer((ONE + TWO).encode(), np.uint8)
    h = roll.span(roll.of_bytes(data), np.array([0, 2048]), np.array([2048, 4096]))
    assert h[0] == h[1]


def test_exact_groups():
    rng = random.Random(4)
    items = np.array([rng.randint(0, 2) for _ in range(400)], np.int64)
    start = np.array([rng.randint(0, 390) for _ in range(300)])
    size = np.array([rng.randint(0, 3) for _ in range(300)])
    owner = np.array([rng.randint(0, 1) for _ in range(300)])
    for keys in (np.zeros(300, np.uint64), items[start].astype(np.uint64) * 0 + size.astype(np.uint64)):
        got = spans.exact_groups(keys, items, start, size, owner)
        names = [(o, tuple(items[a:a + n])) for o, a, n in zip(owner, start, size)]
        assert len(set(zip(names, got.tolist()))) == len(set(names)) == len(set(got.tolist()))


def test_quality_tells_colliding_lines_and_words_apart(spark):
    texts = [f"{ONE}\n{TWO}", f"{ONE}\n{ONE}", f"x y {ONE} z x y {TWO} z", f"x y {ONE} z x y {ONE} z"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_dup_lines, r.n_repeat_words) for r in quality.quality_rules(docs).collect()}
    assert got == {0: (0, 0), 1: (1, 0), 2: (0, 0), 3: (0, 8)}


@pytest.mark.parametrize("block", [1 << 20, 3000])
def test_bpe_tells_colliding_pieces_apart(block):
    tiktoken, public = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    ranks = bpe.read_ranks(public.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = bpe.Encoder(bpe.Vocabulary(ranks))
    texts = ["the " + ONE, "one " + TWO + " and " + ONE + " the", ONE + "!", TWO, "plain words", ""]
    data, offs = spans.text_buffer(pa.array(texts))
    got = []
    for i, j in spans.blocks(offs, block):
        ids, ends = encoder.block(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
        got += [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]
    assert got == [library.encode_ordinary(t) for t in texts]


def test_bpe_survives_wrong_token_hits(monkeypatch):
    public = pytest.importorskip("public_tokenizers")
    ranks = bpe.read_ranks(public.path("byte_bpe_50k.tiktoken"))
    v = bpe.Vocabulary(ranks)
    right = bpe.Encoder(v)
    texts = [" winter", "winters", "hibernation", "zq", "xx", "the"]
    data, offs = spans.text_buffer(pa.array(texts))
    want, ends = right.block(data, offs)
    find = v.by_hash.find
    monkeypatch.setattr(v.by_hash, "find", lambda keys: np.where(keys % np.uint64(3) == 0, 1000, find(keys)))
    got, again = bpe.Encoder(v).block(data, offs)
    assert got.tolist() == want.tolist() and again.tolist() == ends.tolist()


def test_windows_of_colliding_words_and_bytes_stay(spark):
    words = [f"w{i}" for i in range(34)]
    texts = [" ".join(words[:20] + [ONE] + words[20:]), " ".join(words[:20] + [TWO] + words[20:]), " ".join(words + ["end"] * 3), " ".join(words + ["end"] * 3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in fmindex.substring_dedup(docs).collect()}
    assert got == {0: 0, 1: 0, 2: 37, 3: 37}
    base = thue_morse(600, "a", "b")
    texts = [base, thue_morse(600, "b", "a"), "tail " + ONE[:500], "x" * 900]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in suffix.suffix_dedup(docs).collect()}
    count = collections.Counter(t[i:i + 400] for t in texts for i in range(len(t) - 399))
    want = {k: len({i + j for i in range(len(t) - 399) if count[t[i:i + 400]] > 1 for j in range(400)}) for k, t in enumerate(texts)}
    assert got == want


def test_packing_of_colliding_words(spark):
    tokenizers, public = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    import struct
    import zlib
    library = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    texts = [ONE, TWO, ONE + " " + TWO, None, "a b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in packing.pack_documents(docs).collect()}
    want = {}
    for k, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        first = len(ids) - (-(-len(ids) // 2048) - 1) * 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[k, p] = (a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b])))
    assert got == want
