"""Every operator on awkward input: nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""
import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from rttlab.llm import bpe, exact, fmindex, html, packing, quality, simhash, spans, suffix, urls, warc, windows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
random.seed(11)
LONG = " ".join(random.choices(["alpha", "beta", "gämma", "δ", "e."], k=30_000))
PASSAGE = " ".join(f"w{i}" for i in range(90))
TEXTS = [None, "", " \t\n", "one", "A b c", "a  b\tc", PASSAGE, "x y " + PASSAGE + " z", PASSAGE + " tail", LONG, "l1\nl1\nl2 é\n\nl1",
         "same text", "same text", "same  text", "é" * 700, "ab" * 500]
ROWS = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, "no id", None), (11, "same text", "clash")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, kept string").repartition(3)


def words(t):
    return WORD.findall(t or "")


def test_quality(docs):
    got = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                              for r in quality.quality_rules(docs).collect())
    want = collections.Counter()
    for i, t, _ in ROWS:
        w = words(t)
        grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        n = collections.Counter(grams)
        inside = {k + j for k, g in enumerate(grams) if n[g] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        want[i, len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(inside), len(w) < 50 or 100 * len(inside) > 50 * len(w)] += 1
    assert got == want
    assert quality.quality_rules(docs.limit(0)).count() == 0


def test_exact_also_with_colliding_digests(docs):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = collections.defaultdict(list)
    for i, t, _ in ROWS:
        groups[norm(t)].append(i)
    want = collections.Counter()
    for ids in groups.values():
        first = min(ids, key=lambda x: (x is not None, x or 0))
        for k, i in enumerate(sorted(ids, key=lambda x: (x is not None, x or 0))):
            want[i, first, len(ids), k == 0] += 1
    from pyspark.sql import functions as F
    for digest in (exact.sha256_digest, lambda n: F.substring(F.sha2(n, 256), 1, 1)):
        got = collections.Counter((r.id, r.keep_id, r.group_size, r.kept) for r in exact.dedup_classes(docs, digest=digest).collect())
        assert got == want
    assert exact.exact_dedup(docs).count() == len(groups)
    assert exact.exact_dedup(docs).columns == docs.columns
    assert exact.dedup_classes(docs.limit(0)).count() == 0


def components(prints, d):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and bin((a ^ b) & (2 ** 64 - 1)).count("1") <= d:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_fingerprints(docs):
    for r in simhash.fingerprints(docs.filter("doc_id is not null")).collect():
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), TEXTS[r.doc_id] or ""))
        sh = [" ".join(w[k:k + 3]) for k in range(len(w) - 2)] or [" ".join(w)] * bool(w)
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        assert r.fingerprint & (2 ** 64 - 1) == sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(sh))
    out = simhash.near_dedup(docs)
    assert out.columns == docs.columns and out.count() == len({r.root for r in simhash.near_duplicates(docs).collect()})
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("d,large", [(2, 16), (2, 3), (1, 3), (3, 100)])
def test_simhash_links(spark, d, large):
    rng = random.Random(5)
    prints = set()
    for c in range(4):
        x = rng.getrandbits(64)
        for _ in range(40):
            y = x
            for _ in range(rng.randint(0, 4)):
                y ^= 1 << rng.randrange(14 if c < 2 else 64)
            prints.add(y - (1 << 64) if y >> 63 else y)
    nodes = spark.createDataFrame([(x,) for x in prints], "fp long")
    got = {r.fp: r.root for r in simhash.components(nodes, simhash.links(nodes, d, large)).collect()}
    assert got == components(prints, d)


def brute(texts, length, as_bytes):
    seqs = [list((t or "").encode()) if as_bytes else words(t) for t in texts]
    count = collections.Counter(tuple(s[i:i + length]) for s in seqs for i in range(len(s) - length + 1))
    out = []
    for s in seqs:
        gone = {i + j for i in range(len(s) - length + 1) if count[tuple(s[i:i + length])] > 1 for j in range(length)}
        out.append((len(s), len(gone), [x for i, x in enumerate(s) if i not in gone]))
    return out


@pytest.mark.parametrize("hot", [2000, 1])
def test_repeated_windows(spark, hot):
    rng = random.Random(3)
    base = "".join(rng.choices("abcdefgh ", k=500))
    texts = [t for t in TEXTS if t is not LONG] + ["".join(rng.choices("abc ", k=rng.randint(0, 90))) + base[rng.randint(0, 80):rng.randint(300, 500)]
                                                    + "".join(rng.choices("abc ", k=rng.randint(0, 90))) for _ in range(25)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, kept int").repartition(3)
    got = suffix.suffix_dedup(docs, length=60, gram=16, hot_texts=hot).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, list(bytes(r.kept))) for r in got] == brute(texts, 60, True)
    got = fmindex.substring_dedup(docs, length=12, gram=4, hot_texts=hot).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_removed, words(r.kept)) for r in got] == brute(texts, 12, False)
    assert suffix.suffix_dedup(docs.limit(0)).count() == fmindex.substring_dedup(docs.limit(0)).count() == 0
    same = {r.doc_id: r.text for r in fmindex.remove_substrings(docs).collect()}
    assert same[0] is None and same[2] == " \t\n"


def test_long_rows_in_segments(monkeypatch):
    monkeypatch.setattr(windows, "SEGMENT_ITEMS", 100)
    unit = fmindex.word_unit(12, 4)
    parts = list(windows.segments(np.array([0, 20, 470]), unit))
    starts = [s for i, j, a, b in parts[1:] for s in range(a, b - 12 + 1)]
    assert starts == list(range(20, 470 - 12 + 1))


def test_suffix_array_and_fm_index():
    rng = random.Random(2)
    for _ in range(60):
        x = np.array([rng.randint(0, 3) for _ in range(rng.randint(1, 60))], np.int16)
        assert suffix.suffix_array(x, 100).tolist() == sorted(range(len(x)), key=lambda i: tuple(x[i:]))
        texts = [[rng.randint(0, 2) for _ in range(rng.randint(0, 40))] for _ in range(rng.randint(1, 6))]
        flat, length = sum(texts, []), rng.randint(2, 12)
        if not flat:
            continue
        count = collections.Counter(tuple(t[i:i + length]) for t in texts for i in range(len(t) - length + 1))
        want = [i + length <= len(t) and count[tuple(t[i:i + length])] > 1 for t in texts for i in range(len(t))]
        offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        for find, kind in ((suffix.find_repeats, "u1"), (fmindex.find_repeats, "u8")):
            assert find(np.array(flat, kind), offs, np.ones(len(texts), np.int64), length).tolist() == want
            copies = [rng.randint(1, 2) for _ in texts]
            count = collections.Counter()
            for t, c in zip(texts, copies, strict=True):
                for i in range(len(t) - length + 1):
                    count[tuple(t[i:i + length])] += c
            more = [i + length <= len(t) and count[tuple(t[i:i + length])] > 1 for t in texts for i in range(len(t))]
            assert find(np.array(flat, kind), offs, np.array(copies), length).tolist() == more
            count = collections.Counter(tuple(t[i:i + length]) for t in texts for i in range(len(t) - length + 1))


@pytest.fixture(scope="module")
def reference():
    tiktoken, public = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.tiktoken")
    ranks = bpe.read_ranks(path)
    return path, tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={}), bpe.Vocabulary(ranks)


def test_bpe_equals_the_library(docs, reference):
    path, library, v = reference
    rng = random.Random(1)
    bits = ["a", "'s", "'ll", " ", "  ", "\n", "\t", "é", "日本", "1", "½", "!", "...", "'", "I'm", "\r\n", "🙂", "\x1c", "\x85", "the ", " '", "<|endoftext|>"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 30))) for _ in range(3000)] + ["", "a" * 500, " " * 300, "日本語" * 90]
    data, offs = spans.text_buffer(pa.array(texts))
    ids, ends = bpe.Encoder(v).block(data, offs)
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [library.encode_ordinary(t) for t in texts]
    rows = bpe.decode(bpe.encode(docs.filter("doc_id is not null"), path), path).collect()
    assert sorted((r.doc_id, r.ids, bytes(r.decoded)) for r in rows) == sorted(
        (i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in ROWS if i is not None)
    digests = {r.doc_id: r.ids_sha256 for r in bpe.decimal_digest(bpe.encode(docs, path)).collect()}
    assert digests[4] == hashlib.sha256(" ".join(map(str, library.encode_ordinary("A b c"))).encode()).hexdigest()
    assert digests[0] == hashlib.sha256(b"").hexdigest()


def test_prefix_table_appends_and_edits(reference):
    _, library, v = reference
    rng = random.Random(4)
    for _ in range(40):
        table = bpe.PrefixTable(v, bytes(rng.choices(b"abehinorst ", k=rng.randint(1, 60))))
        table.append(b"ing")
        a = rng.randint(0, len(table.piece))
        table.replace(a, rng.randint(a, len(table.piece)), b"the")
        assert table.last == bpe.PrefixTable(v, table.piece).last


def test_bin_completion():
    rng = random.Random(6)
    for sizes in ([rng.randint(1, 100) for _ in range(300)], [rng.randint(24, 45) for _ in range(200)], [51] * 7, [100], []):
        counts = collections.Counter(sizes)
        p = packing.bin_completion(dict(counts), 100, nodes=300)
        assert all(sum(n * c for n, c in pattern.items()) <= 100 for pattern, _ in p.patterns)
        used = collections.Counter()
        for pattern, m in p.patterns:
            for n, c in pattern.items():
                used[n] += c * m
        assert used == counts
        assert packing.lower_bound(dict(counts), 100) <= p.sequences <= packing.largest_first(counts, 100).sequences if sizes else not p.patterns


def fewest(sizes, capacity):
    best = len(sizes)

    def place(i, bins):
        nonlocal best
        if len(bins) < best and i == len(sizes):
            best = len(bins)
        if len(bins) >= best:
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity and bins[k] not in bins[:k]:
                place(i + 1, [*bins[:k], bins[k] + sizes[i], *bins[k + 1:]])
        place(i + 1, [*bins, sizes[i]])

    sizes = sorted(sizes, reverse=True)
    place(0, [])
    return best


def test_bin_completion_finds_the_fewest():
    rng = random.Random(9)
    cases = [([39, 43, 45, 49, 51, 54, 55, 56, 56, 59, 60], 150), ([9, 11, 13, 13, 15, 17, 19, 20, 20, 20, 21, 22, 25, 25], 50),
             ([273, 284, 313, 314, 337, 359, 361, 365, 370, 376, 379, 382, 395], 1000)]
    cases += [([rng.randint(c // rng.choice([4, 5, 20]), c // 2) for _ in range(rng.randint(1, 11))], c) for c in [20, 30, 60, 100] * 30]
    for sizes, capacity in cases:
        assert packing.bin_completion(dict(collections.Counter(sizes)), capacity).sequences == fewest(sizes, capacity)


def test_fillings_are_all_that_are_undominated():
    rng = random.Random(10)

    def held(b, a):  # whether groups of b fit into the places of a
        return not b or any(x >= b[0] and held(b[1:], [*a[:k], x - b[0], *a[k + 1:]]) for k, x in enumerate(a))

    for docs, space in [([6, 4, 4, 2], 8), ([7, 6, 5, 3, 2, 1], 8)] + [([rng.randint(1, 12) for _ in range(8)], rng.randint(1, 25)) for _ in range(40)]:
        counts = collections.Counter(docs)
        every = {tuple(sorted(d for k, d in enumerate(docs) if m >> k & 1)) for m in range(256)}
        every = [list(x[::-1]) for x in every if sum(x) <= space]
        want = [b for b in every if not any(a != b and held(b, a) for a in every)]
        got = [sorted((n for n, c in f.items() for _ in range(c)), reverse=True) for f in packing.fillings(counts, sorted(counts, reverse=True), space) if f is not None]
        assert sorted(got) == sorted(want)


def test_packing_is_gapless(docs):
    rows = packing.pack_documents(docs).collect()
    assert sum(r.length for r in rows if r.doc_id == 0) == 1
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    cut = sorted((r.piece, r.start, r.length) for r in rows if r.doc_id == 9)
    assert [x[2] for x in cut[1:]] == [2048] * (len(cut) - 1)
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_urls(spark):
    rows = [(1, "HTTP://A.Example.ORG/en/12?q#f"), (2, "http://org/"), (3, None), (4, "no scheme"), (5, "http://x.net/a/"), (6, "https://www.x.net/a#z"),
            (7, "http://b.com/de/x"), (8, "http://forexample.org/es/"), (9, "http://x.net/b"), (9, "http://x.net/b"), (10, "http://example.org?x/en/1")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, rule string")
    listed = spark.createDataFrame([("x.net/a",), ("x.net/a",), (None,)], "url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.url_filter(pages, listed, urls.RULES).collect()}
    assert got[1] == ("a.example.org", "/en/12", "example.org/en/1", "block")
    assert got[2] == ("org", "/", "org/", "allow")
    assert got[3] == got[4] == ("", "", None, "allow")
    assert got[5][3] == got[6][3] == "block" and got[9][3] == "allow"
    assert got[7][2:] == ("com/de/", "block") and got[8][2] == "org/" and got[10] == ("example.org", "", None, "allow")
    assert urls.url_filter(pages, listed, urls.RULES).count() == len(rows)
    assert urls.url_filter(pages.limit(0), listed.limit(0), urls.RULES).count() == 0


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "http://B.org/x", "\r\n\r\nstarts\r\n"), (2, None, None), (3, "http://a.org/é\n", "é" * 600), (4, "http://a.org/", "é" * 600),
            (5, "u", "WARC/1.1\r\n\r\n" * 3), (6, "u", "é" * 600), (None, "u", ""), (7, "u", "short"), (8, "u", "short")]
    pages = spark.createDataFrame([(*r, "2024-01-01T00:00:00Z") for r in rows], "page_id long, url string, html string, captured string").repartition(2)
    out = warc.build_archives(pages, str(tmp_path / "w")).collect()
    assert len(out) == len(rows)
    got = {r.page_id: r for r in out}
    for i, _, h in rows:
        body = (h or "").encode()
        assert (got[i].payload_length, got[i].payload_digest) == (len(body), hashlib.sha1(body).hexdigest())
    assert {i: (r.record_type, r.refers_to) for i, r in got.items() if r.record_type == "revisit"} == {3: ("revisit", 6), 4: ("revisit", 6)}
    keys = [(r.url_key, r.captured, r.page_id or 0) for r in sorted(out, key=lambda r: (r.index_part, r.index_row))]
    assert keys == sorted(keys)
    blocks = {r.page_id: bytes(r.block) for r in warc.read_archives(spark, str(tmp_path / "w" / "archives")).collect()}
    assert blocks[5] == b"WARC/1.1\r\n\r\n" * 3 and blocks[1] == b"\r\n\r\nstarts\r\n" and blocks[3] == b""
    empty = pages.limit(0)
    assert warc.build_archives(empty, str(tmp_path / "e")).count() == 0


def test_capture_history_crosses_ranges(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, rng.choice(["http://a.org/", "http://a.org/x", "http://b.org/", None]), f"page {i}", f"2024-01-{1 + rng.randrange(28):02d}T00:00:00Z") for i in range(120)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, captured string").repartition(3)
    index = warc.build_archives(pages, str(tmp_path / "w"))
    assert len({r.index_part for r in index.collect()}) > 2
    got = {r.page_id: r.previous_page for r in warc.capture_history(index).collect()}
    want, last = {}, {}
    for i, url, _, at in sorted(rows, key=lambda r: (r[1] or "", r[3], r[0])):
        want[i] = last.get(url)
        last[url] = i
    assert got == want


@pytest.mark.parametrize("ends", [0, 1, 2, 3, 4])
def test_warc_archive_ends_in_line_ends(spark, tmp_path, ends):
    body = "A\r\nB" + "\r\n" * ends
    pages = spark.createDataFrame([(1, "u", body, "2024-01-01T00:00:00Z")], "page_id long, url string, html string, captured string")
    out = warc.build_archives(pages, str(tmp_path / "w")).collect()
    assert [(r.page_id, r.payload_length, r.payload_digest) for r in out] == [(1, len(body), hashlib.sha1(body.encode()).hexdigest())]
    assert [bytes(r.block) for r in warc.read_archives(spark, str(tmp_path / "w" / "archives")).collect()] == [body.encode()]


def test_loser_tree():
    rng = random.Random(8)
    for k in range(9):
        runs = [sorted(rng.randint(0, 30) for _ in range(rng.randint(0, 12))) for _ in range(k)]
        assert list(warc.LoserTree([((x, x) for x in r) for r in runs])) == sorted(sum(runs, []))


def test_html(spark):
    assert html.main_text('<div id=cookie-notice>We use</div><ul class="menu"><li>A</ul><p>Hello&nbsp;w&ouml;rld <i>x</i>y<p>Two<table><tr><td>a<td>b'
                          '</table><div class="comments"><article class=comment>no</article></div><script>if (a<b) "</p>"</script>') == "Hello wörld xy Two a b"
    assert html.main_text("<header>H</header><article><header><h1>T</h1></header><p>a<br>b<form>f</form></p><aside>s</aside></article><p>out") == "T a b"
    assert html.main_text('<p "x>a<p>b<!-- c') == "a b" and html.main_text("") == ""
    page = lambda i: f"<body><div>Site &copy; line</div><p>text {i}</p><section><p>Follow us</p></section></body>"
    rows = [(i, "http://h.org/", page(i), "clash") for i in range(12)] + [(99, "http://other.org/", page(99), None), (100, None, None, None), (3, "http://h.org/", page(3), "clash")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)
    got = collections.defaultdict(list)
    for r in html.extract(pages).collect():
        got[r.page_id].append((r.text, r.n_chars))
    assert got[5] == [("text 5", 6)] and got[3] == [("text 3", 6)] * 2
    assert got[99] == [("Site © line text 99 Follow us", 29)] and got[100] == [("", 0)]
    assert html.extract(pages.limit(0)).count() == 0


def test_html_equal_pages_are_no_template(spark):
    bodies = {"plain": "<div><p>Long text of its own.</p></div>", "div": "<article><div><p>Long text of its own.</p></div></article>",
              "section": "<article><section><div>Long text of its own.</div></section></article>", "main": "<main><div><h1>Long text</h1>of its own.</div></main>"}
    rows = [(i, u and f"http://{u}.org/{k}/{i}", f"<body>{b}</body>") for k, b in bodies.items() for i, u in enumerate([k] * 12)]
    rows += [(i, None, f"<body>{bodies['plain']}</body>") for i in range(12)] + [(1, "http://rows.org/", f"<body>{bodies['plain']}</body>")] * 12
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    assert len(got) == len(rows) and {r.text for r in got} == {"Long text of its own."}


def test_html_article_keeps_its_text(spark):
    # pages that differ outside the article only, and an article's box that recurs
    kept = [("div", "<div><p>Long text of its own.</p></div>"), ("bare", "<div>Long text</div><div>of its own.</div>"),
            ("box", "<div><p>Long text of its own.</p></div><div>Follow us</div>")]
    rows = [(i, f"http://{k}.org/{i}", f"<body><div>Page {i}</div><article>{b}</article></body>") for k, b in kept for i in range(12)]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    assert len(got) == len(rows) and {r.text for r in got} == {"Long text of its own."}
