"""The corpus operators against brute force on small fixtures, with nulls, empties, ties and clashing columns."""

import base64
import bz2
import collections
import gzip
import hashlib
import lzma
import random
import re
import urllib.parse
import zlib

import pytest

from emporia.llm import bpe, chat, decontaminate, exact_dedup, html_wrapper, minhash, pii, quality, repeats, secrets

DOC = "doc_id long, text string, digest string, bucket long, h long, w string"


def docs(spark, texts):
    """Texts as documents, with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "x", 1, 2, "y") for i, t in enumerate(texts)], DOC)


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}{rng.choice('abc')}" for _ in range(n))


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


# 1
def test_secret_layers_map_to_the_text():
    token = 'token = "0123456789abcdef0123"'
    b64 = base64.b64encode(token.encode()).decode()
    for packed in (b64, base64.b64encode(gzip.compress(token.encode())).decode(), base64.b64encode(zlib.compress(b64.encode())).decode(),
                   base64.b64encode(b64.encode()).decode(), urllib.parse.quote(b64, safe=""), "".join(f"\\u{ord(c):04x}" for c in token)):
        text = f"é 𝒳 before {packed} after"
        base, spans, _ = secrets.scan(text)
        assert set(base) <= set(spans)
        a, b = next((a, b) for a, b, k in spans if k == "assign")
        start = text.index(packed)
        assert start <= a < b <= start + len(packed), packed


def test_secret_base_has_no_retries():
    assert secrets.find("token: password: abcdefghijklmn") == []
    assert secrets.find("API_KEY='abcdefghijkl'") == [(0, 21, "assign")]
    assert secrets.find("to\u212aen=abcdefghijklmnop") == []  # the Kelvin sign is no k
    assert secrets.scan(None) == ([], [], 0) and secrets.scan("")[1] == []


def test_secret_scan_reads_a_long_run_once():
    text = "% \\ &# " + "a1/" * 200_000 + "%41KIA0123456789ABCDEF"  # quadratic if the run is tried from each character
    base, spans, _ = secrets.scan(text)
    at = text.index("%41")
    assert base == [] and spans == [(at, at + 22, "access")]


@pytest.mark.parametrize("text", ['a password="AbCd%2BEfGhIjKlMnOp" b', "a token: AbCd%2BEfGhIjKlMnOp b", 'a "api_key": "AbCd\\u002BEfGhIjKlMnOp" b',
                                  "a t%6Fken: AbCdEfGhIjKlMnOp b", "a &#116;oken = AbCdEfGhIjKlMnOp b", "a \\u0074oken: AbCd%252BEfGhIjKlMnOp b"])
def test_secret_keyword_and_value_meet_across_escapes(text):
    base, spans, _ = secrets.scan(text)
    a = min(text.index(k) for k in ("pass", "t%6F", "&#116;", "\\u0074", "token", "api") if k in text)
    assert base == []
    assert (a, text.index("MnOp") + 4, "assign") in spans


def test_secret_stretches_stay_layers_of_their_own():
    text = "token: password%3A%20abcdefghijklmn"  # in the whole layer the keyword is the first one's value
    assert (7, len(text), "assign") in secrets.scan(text)[1]


def wrapped(data, n=76, end="\n"):
    b = base64.b64encode(data).decode()
    return end.join(b[i : i + n] for i in range(0, len(b), n))


NOISE = random.Random(12).randbytes(150)
SECRET = b"token = AbCdEfGhIjKlMnOp0123"
PACKED = gzip.compress(NOISE.hex().encode()[:40] + b" " + SECRET)


@pytest.mark.parametrize("packed", [
    *[f"{glue}{base64.b64encode(SECRET).decode()}" for glue in ("/x/", "ab_", "k-", "/a/longer/path/", "x")],
    *[f"{glue}{base64.b64encode(PACKED).decode()}" for glue in ("/x/", "ab_", "k-", "")],
    *[wrapped(b"first line of some words, then more of them, " + SECRET, 64, end) for end in ("\n", "\r\n  ", "\\n")],
    wrapped(gzip.compress(NOISE + SECRET)), wrapped(bz2.compress(NOISE + SECRET)), wrapped(lzma.compress(NOISE + SECRET)),
    urllib.parse.quote(PACKED), "".join(f"%{c:02x}" for c in PACKED), "".join(f"\\x{c:02x}" for c in PACKED), str(PACKED)[2:-1],
    "".join(f"\\u{c:04x}" for c in PACKED), "data=" + urllib.parse.quote(zlib.compress(SECRET)),
    base64.b64encode(gzip.compress(b"nothing") + PACKED).decode(), base64.b64encode(gzip.compress(b"toke") + gzip.compress(SECRET[4:])).decode(),
    *[base64.b64encode(SECRET.decode().encode(code)).decode() for code in ("utf-16", "utf-16-le", "utf-16-be")],
    base64.b64encode("clé ".encode("latin-1") + SECRET).decode(), base64.b64encode(gzip.compress(urllib.parse.quote(PACKED).encode())).decode()])
def test_secret_layers_in_every_form(packed):
    text = f"é before {packed} after"
    base, spans, unopened = secrets.scan(text)
    start = text.index(packed)
    assert any(start <= a < b <= start + len(packed) for a, b, k in spans if k == "assign") and not unopened


def test_secret_streams_beyond_a_layer_are_read_in_blocks(monkeypatch):
    monkeypatch.setattr(secrets, "LAYER_BYTES", 1 << 16)
    monkeypatch.setattr(secrets, "PIECE", 1 << 12)
    for at in (0, (1 << 16) - 10, 300_000):
        packed = base64.b64encode(gzip.compress(b"." * at + SECRET + b"." * 400_000)).decode()
        base, spans, unopened = secrets.scan(f"a {packed} b")
        assert spans == [(2, 2 + len(packed), "assign")] and not unopened
    inner = gzip.compress(random.Random(13).randbytes(200_000) + SECRET)
    assert secrets.scan(base64.b64encode(gzip.compress(b"." * 60_000 + inner)).decode())[2] > 0


# 2
def brute_repeats(texts, k=400):
    data = [(t or "").encode() for t in texts]
    count = collections.Counter(d[i : i + k] for d in data for i in range(len(d) - k + 1))
    out = []
    for d in data:
        covered = bytearray(len(d))
        for i in range(len(d) - k + 1):
            if count[d[i : i + k]] > 1:
                covered[i : i + k] = b"\1" * k
        spans = len(re.findall(rb"\x01+", bytes(covered)))
        out.append((len(d), sum(covered), spans, sha(bytes(c for c, x in zip(d, covered, strict=True) if not x))))
    return out


@pytest.mark.parametrize("hot", [repeats.HOT_SEGMENTS, 1])
def test_repeats_equal_brute_force(spark, hot):
    rng = random.Random(3)
    p, q = prose(rng, 130), prose(rng, 160)
    texts = [None, "", "é" * 300, "a" * 2000, p, p, prose(rng, 50) + p + prose(rng, 80), q[:450] + prose(rng, 60), prose(rng, 70) + q[30:],
             "xyz" * 400, prose(rng, 300), q + prose(rng, 20) + q]
    texts += [f"{rng.random()} " + p[100:600] + f" {rng.random()}" for _ in range(8)]
    got = {r.doc_id: tuple(r)[1:] for r in repeats.remove(docs(spark, texts), hot_segments=hot).collect()}
    assert [got[i] for i in range(len(texts))] == brute_repeats(texts)


# 3
def test_fuse_filter_has_no_false_negatives():
    import numpy as np

    for n in (1, 2, 10, 1000, 20000):
        keys = np.random.default_rng(n).integers(0, 2**63, n, dtype=np.uint64)
        f = exact_dedup.BinaryFuse.build(keys)
        assert f.contains(keys).all()
        other = np.random.default_rng(n + 1).integers(0, 2**63, 20000, dtype=np.uint64)
        assert f.contains(other).mean() < 0.01


@pytest.mark.parametrize("batches", [1, 2, 3])
def test_exact_dedup_equals_brute_force(spark, batches):
    texts = ["a b", "a  b", None, "", "a\tb", "c", "a b", " ", "\n", *["hot"] * 40]
    group = collections.defaultdict(list)
    for i, t in enumerate(texts):
        group[re.sub("[\x20\x09-\x0d]+", " ", t or "")].append(i)
    want = {i: (g[0], len(g)) for g in group.values() for i in g}
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.classes(docs(spark, texts), batches).collect()}
    assert got == want


def test_exact_dedup_takes_null_and_repeated_ids(spark):
    rows = [(1, "other"), (2, "same"), (1, "same"), (7, "same"), (None, "only null"), (None, "only null"), (None, "same"), (8, None), (3, "")]
    rows += [(i, "x") for i in range(20, 60)] + [(20, "y")] + [(i, "y") for i in range(60, 90)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    least = {}
    for i, t in rows:
        least[t or ""] = min((x for x in (least.get(t or ""), i) if x is not None), default=None)
    for batches in (1, 2, 3):
        got = sorted((tuple(r) for r in exact_dedup.classes(frame, batches).select("doc_id", "keep_id", "group_size").collect()), key=str)
        want = sorted(((i, least[t or ""], sum((u or "") == (t or "") for _, u in rows)) for i, t in rows), key=str)
        assert got == want
    kept = sorted((tuple(r) for r in exact_dedup.dedup(frame).collect()), key=str)
    assert kept == sorted([(i, t) for i, t in rows if i == least[t or ""]], key=str)


# 4
def brute_hits(texts, items):
    tr = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(tr))
    windows = collections.defaultdict(set)
    for item, t in items:
        w = words(t)
        for i in range(max(len(w) - 9, 1) if w else 0):
            windows[tuple(w[i : i + 10])].add(str(item))
    out = []
    for t in texts:
        w, hit, found = words(t), set(), set()
        for g, who in windows.items():
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i : i + len(g)]) == g:
                    hit |= set(range(i, i + len(g)))
                    found |= who
        out.append((len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("bound", [decontaminate.SET_WINDOWS, 0])
def test_decontamination_equals_brute_force(spark, bound):
    rng = random.Random(5)
    items = [(1, prose(rng, 14)), (2, "Short one É"), (3, None), (4, ""), (10, prose(rng, 10)), (5, prose(rng, 30))]
    texts = [None, "", "x Short, ONE É! short one é", "short one", items[0][1].upper(), prose(rng, 20) + " " + items[5][1][:60], items[4][1] + " " + items[5][1]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in decontaminate.scan(docs(spark, texts), bench, bound).collect()}
    assert [got[i] for i in range(len(texts))] == brute_hits(texts, items)


# 5
def test_bag_minhash_estimates_weighted_jaccard():
    import numpy as np

    rng = random.Random(1)
    a = [f"w{rng.randrange(60)}" for _ in range(600)]
    b = a[:420] + [f"v{rng.randrange(60)}" for _ in range(180)]
    r, g, c, _ = minhash.batch_shingles([" ".join(a).encode(), " ".join(b).encode()])
    sig = minhash.bag_minhash(r, g, c, 2, slots=4096)
    exact = minhash.weighted_jaccard(g[r == 0], c[r == 0], g[r == 1], c[r == 1])
    assert abs(float(np.mean(sig[0] == sig[1])) - exact) < 0.03
    r, g, c, _ = minhash.batch_shingles([b"x " * 3000, b"x " * 1500])
    sig = minhash.bag_minhash(r, g, c, 2, slots=4096)
    assert abs(float(np.mean(sig[0] == sig[1])) - 0.5) < 0.03


def test_near_classes_equal_brute_force(spark):
    rng = random.Random(2)
    base = prose(rng, 120, 5000).split()

    def edited(n):
        w = list(base)
        for i in rng.sample(range(len(w)), n):
            w[i] = f"z{rng.random()}"
        return " ".join(w)

    texts = [None, "", "!!", "one two", "one two", "One, two"] + [edited(n) for n in range(6) for _ in range(6)] + [" ".join(base)] + [prose(rng, 60, 9000) for _ in range(5)]
    bags = []
    for t in texts:
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").lower())
        bags.append(collections.Counter(zip(*[w[i:] for i in range(5)], strict=False)) if len(w) >= 5 else collections.Counter([tuple(w)] if w else []))
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            o = sum((bags[i] & bags[j]).values())
            u = sum(bags[i].values()) + sum(bags[j].values()) - o
            if u and o / u >= 0.8:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    got = {r.doc_id: r.class_id for r in minhash.classes(docs(spark, texts)).collect()}
    assert got == {i: find(i) for i in range(len(texts))}


# 6
def test_wrapper_drops_what_is_not_the_article(spark):
    page = ("<html><head><title>T</title><script>var a='</p>';</script></head><body><header>site</header><nav><ul><li>a<li>b</ul></nav>"
            "<div class='cookie-notice'>we use</div><article><h1>Head &amp; {0}</h1><p>One <b>bold<br>two<p>Three &lt;{0}&gt;"
            "<aside>side</aside><form>f</form><section class='comments'><p>no</section></article><footer>f</footer>")
    pages = [(i, f"http://h.example/{i}", page.format(i)) for i in range(5)] + [(9, None, None), (10, "x", ""), (11, "http://other.example/", "<p>plain <i>text</i>")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_wrapper.extract(frame).collect()}
    for i in range(5):
        assert got[i][0] == f"Head & {i}\nOne bold two\nThree <{i}>"
    assert got[9] == ("", 0) and got[10] == ("", 0) and got[11][0] == "plain text"


def test_alignment_makes_optional_and_repeated_groups():
    a, b = html_wrapper.tree("<div><p>x</p></div>")[0], html_wrapper.tree("<div><p>x</p><p>y</p></div><ul><li>z</ul>")[0]
    got = html_wrapper.align(a[1], b[1])
    assert [(n[0], n[2], n[3]) for n in got] == [("div", False, False), ("ul", True, False)]
    assert got[0][1][0][3]  # p repeats


def extracted(spark, pages):
    frame = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in html_wrapper.extract(frame).collect()}


def test_regions_are_chosen_per_page(spark):
    pages = [("http://h.example/a", "<article><p>in</p></article><div><p>out</p></div>"), ("http://h.example/b", "<div><p>plain</p></div>"),
             (None, "<main>pool</main>"), ("no url", "<div><p>other site</p></div>")]
    assert extracted(spark, pages) == {0: "in", 1: "plain", 2: "pool", 3: "other site"}


def test_constant_texts_leave_alone_what_shares_their_path(spark):
    pages = [("http://h.example/", f"<body><div><p>Always first</p><p>one {i}</p><p>two {i}</p><p>Thanks for reading.</p></div></body>") for i in range(10)]
    assert extracted(spark, pages) == {i: f"one {i}\ntwo {i}" for i in range(10)}
    pages = [("http://h.example/", f"<div><p>{'Same' if i < 5 else 'x'}</p><ul><li>z{i}</ul><p>{'Same' if i >= 5 else 'y'}</p></div>") for i in range(10)]
    got = extracted(spark, pages)  # on half of the pages at either position
    assert got[0] == "Same\nz0\ny" and got[9] == "x\nz9\nSame"


def test_matching_covers_every_page():
    rng = random.Random(11)

    def part(depth):
        return "".join(rng.choice(["t<hr>", f"<p>a{part(depth - 1)}</p>" if depth else "b", f"<div>{part(depth - 1)}</div>" if depth else "c", "<ul><li>x<li>y</ul>"])
                       for _ in range(rng.randrange(4)))

    trees = [html_wrapper.tree(part(3))[0] for _ in range(60)]
    wrapper = trees[0]
    for t in trees[1:]:
        wrapper = html_wrapper.joined(wrapper, t)
    groups = html_wrapper.numbered(wrapper[1])
    for t in trees:
        own = html_wrapper.numbered(t[1])
        assert [k for k, _ in html_wrapper.match(own, groups)] == list(range(sum(x[3] for x in own)))


# 7
def test_quality_separates_held_out_rows(spark):
    rng = random.Random(4)
    texts = [prose(rng, 80) + "." if i % 3 else "### $$$ | " * 40 for i in range(300)] + [None, ""]
    labels = spark.createDataFrame([(i, 1 if i % 3 else 0) for i in range(300)] + [(2, None)], "doc_id long, quality int")
    rows = quality.scored(docs(spark, texts), labels).collect()
    assert len(rows) == 302 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id < 300]
    assert all(r.predicted == (1 if r.doc_id % 3 else 0) for r in held)
    assert {r.score for r in quality.scored(docs(spark, texts[:3]), labels.limit(0)).collect()} == {0.5}


def test_accepted_rows_go_by_their_text(spark):
    rng = random.Random(4)
    texts = [prose(rng, 80) + "." if i % 3 else "### $$$ | " * 40 for i in range(300)]
    labels = spark.createDataFrame([(i, 1 if i % 3 else 0) for i in range(300)], "doc_id long, quality int")
    more = [(None, prose(rng, 80) + "."), (None, texts[0]), (1, texts[0])]  # the last one has a good row's id
    frame = spark.createDataFrame([*enumerate(texts), *more], "doc_id long, text string")
    kept = collections.Counter((r.doc_id, r.text) for r in quality.accepted(frame, labels).collect())
    assert kept[more[0]] == 1 and not kept[more[1]] and not kept[more[2]] and kept[1, texts[1]] == 1


# 8
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_pii(text):
    out = []
    for k, kind in enumerate(pii.KINDS):
        for m in re.finditer(BASE[kind], text or ""):
            d = re.sub("[^0-9]", "", m.group())
            luhn = sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))) % 10 == 0
            if kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")) or (
                    kind == "card" and 12 <= len(d) <= 19 and luhn) or kind == "phone" and 9 <= len(d) <= 15:
                out.append((m.start(), k, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def test_pii_base_equals_brute_force(spark):
    rng = random.Random(6)
    pool = ["a@b.c", "x@y.com_z@w.org", "a@b-c_d@e.f", "1.2.3.4.5", "256.1.1.1", "001.2.3.4", "4111 1111-1111 1111", "4111111111111112",
            "+1 (274) 555-2202", "+1 2", "(499) 555-6503", "é𝒳", "@", "..", " ", "\n", "-", "7", "john (at) site (dot) com", "+" * 3, "9" * 40]
    texts = [None, "", "x" * 50_000, "1" * 30_000] + ["".join(rng.choice(pool) for _ in range(rng.randrange(12))) for _ in range(300)]
    for r in pii.detect(docs(spark, texts)).collect():
        assert r.base == brute_pii(texts[r.doc_id]), texts[r.doc_id]
        assert set(filter(None, r.base.split(","))) <= set(r.spans.split(","))


# 9
def test_chat_round_trip(spark):
    said = ["</s>[INST] ok [/INST]", "a\\b <|im_end|>\n<|im_start|>user\n", "<|im_end|>", "\\", "", None, "<", "|im_end|>", "\\<|im_end|>\\\\"]
    turns = [(c, t, "user" if t % 2 == 0 else "assistant", said[(c + t) % len(said)]) for c in range(9) for t in range(4)]
    turns += [(50, 0, "assistant", "x"), (51, 0, None, "y"), (51, 0, None, "y"), (None, 0, "sys\ntem", "z")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    rows = {r.conv_id: r for r in chat.read_segments(chat.format_segments(frame)).collect()}
    by = collections.defaultdict(list)
    for c, t, role, text in turns:
        by[c].append((t, role or "", text or ""))
    assert set(rows) == set(by)
    for c, got in by.items():
        got.sort()
        assert rows[c].n_turns == len(got)
        assert rows[c].turns_sha256 == sha("".join(f"{r}\n{x}\n" for _, r, x in got))
        lost = "".join(x for _, r, x in got if r == "assistant")
        assert (rows[c].loss_chars, rows[c].loss_sha256) == (len(lost), sha(lost))
    assert rows[0].valid and not rows[50].valid


# 10
@pytest.fixture(scope="module")
def codec():
    P = pytest.importorskip("public_tokenizers")
    return bpe.BpeCodec(bpe.load_rules(P.path("byte_bpe_50k.json")), cache=500)


def test_bpe_equals_the_library(codec):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rng = random.Random(8)
    texts = ["", "<|endoftext|>a<|endoftext|>", "  a b", "a\n \nb", "it's 'll", "x" * 150_000, " " * 70_000 + "a", "é中𝒳" * 3000, "a  " * 30_000]
    texts += ["".join(rng.choice("aabthe  \n\t'sl1é中!<|") for _ in range(rng.randrange(80))) for _ in range(400)]
    codec.warm(texts)
    for x in texts:
        ids = t.encode(x, add_special_tokens=False).ids
        text = t.decode(ids, skip_special_tokens=False)
        assert codec.digests(x) == (len(ids), sha(",".join(map(str, ids))), sha(text))
        assert list(codec.encode(x)) == ids and "".join(codec.decode(ids)) == text


def test_bpe_opening_quotes_equal_the_library(codec):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for w in ("'man", "'three", "'very", "'said", "'down", "'lleno", "'real", "'s", "'x", "!man", "\tman", "1man", "éa", "ªb"):
        for x in (w, w + " and more", f"<|endoftext|>{w} a", f"a {w} b", f"{w} {w}", f"{w}  b"):
            ids = t.encode(x, add_special_tokens=False).ids
            for warm in ([], [x]):
                codec.warm(warm)
                assert codec.digests(x)[:2] == (len(ids), sha(",".join(map(str, ids)))), x


def test_bpe_windows_cut_anywhere_equal_the_library(codec, monkeypatch):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rng = random.Random(21)
    texts = ["".join(rng.choice("aab  \n\t\x1c\u3000'sl1é中!") for _ in range(rng.randrange(400))) for _ in range(300)]
    for chunk in (16, 37, 100):
        monkeypatch.setattr(bpe, "CHUNK", chunk)
        for x in texts:
            ids = t.encode(x, add_special_tokens=False).ids
            assert codec.digests(x)[:2] == (len(ids), sha(",".join(map(str, ids)))), (chunk, x)


@pytest.mark.parametrize("unit", ["word an\n\n", "it's  1 ", "ab", "中!"])
def test_bpe_memory_does_not_grow_with_the_text(codec, unit, monkeypatch):
    import tracemalloc

    monkeypatch.setattr(bpe, "CHUNK", 1 << 11)
    peaks = []
    for size in (1 << 13, 1 << 16):
        text = unit * (size // len(unit))
        tracemalloc.start()
        codec.warm([text])
        codec.digests(text)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    # The splitter's and the callers' copies of the text itself are all that may grow.
    assert peaks[1] < peaks[0] + 3 * (1 << 16) * (1 if text.isascii() else 2)


def test_lookahead_suffices(codec):
    rng = random.Random(9)
    for _ in range(20):
        w = bytes(rng.choice(b"thernAB aaxe") for _ in range(rng.randrange(1, 3000)))
        assert list(codec.transduce([w])) == codec.merge(w)


# all
def test_empty_tables(spark):
    none = docs(spark, [])
    assert repeats.remove(none).count() == 0
    assert exact_dedup.classes(none).count() == 0
    assert minhash.classes(none).count() == 0
    assert pii.detect(none).count() == 0
    assert secrets.scan_documents(none).count() == 0
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.scan(none, bench).count() == 0
    assert [r.n_hit for r in decontaminate.scan(docs(spark, ["a b"]), bench).collect()] == [0]
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.scored(none, labels).count() == 0
    assert html_wrapper.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline as pipe

    names = [n for n, _ in pipe.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "near_dedup", "decontamination", "bpe"]
    sf = "/root/testdata/sf0.001"
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r.doc_id for r in pipe.run(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    hits = brute_hits([r.text for r in frame.orderBy("doc_id").collect()], [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()])
    ids = sorted(r.doc_id for r in frame.select("doc_id").collect())
    assert kept and not any(n for i, (_, n, _) in zip(ids, hits, strict=True) if i in kept)
    good = [i for i in ids if labels.get(i) == 1]
    assert len(kept & set(good)) > 0.6 * len(good)


def test_pipeline_equals_brute_force(spark):
    import corpus_pipeline as pipe

    sf = "/root/testdata/sf0.001"
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    rows = quality.accepted(frame, spark.read.parquet(f"{sf}/labels.parquet")).select("doc_id", "text").collect()
    texts, first = {r.doc_id: r.text or "" for r in rows}, {}
    for i in sorted(texts):
        first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", texts[i]), i)
    left = sorted(first.values())
    bags = {}
    for i in left:
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), texts[i]))
        bags[i] = collections.Counter(zip(*[w[k:] for k in range(5)], strict=False)) if len(w) >= 5 else collections.Counter([tuple(w)] if w else [])
    size = {i: sum(b.values()) for i, b in bags.items()}
    parent = {i: i for i in left}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in left:
        for j in left:
            if j < i and min(size[i], size[j]) >= 0.8 * max(size[i], size[j]) and size[i]:
                o = sum((bags[i] & bags[j]).values())
                if o / (size[i] + size[j] - o) >= 0.8:
                    a, b = sorted((find(i), find(j)))
                    parent[b] = a
    left = [i for i in left if find(i) == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    left = [i for i, hit in zip(left, brute_hits([texts[i] for i in left], items), strict=True) if not hit[1]]
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(pipe.tokenizer_path())
    want = {}
    for i in left:
        ids = t.encode(texts[i], add_special_tokens=False).ids
        want[i] = (len(ids), sha(",".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False)))
    got = [tuple(r) for r in pipe.run(spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()]
    assert len(got) == len(want) < len(rows) and {r[0]: r[1:] for r in got} == want
