"""Main text, fill-in-the-middle and conversation repair against plain versions on small fixtures."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.llm import html_text, infill, pages, queries, repair, shards, urls, warc
from lamina.llm import sql as llm_sql

PAGES = "page_id long, url string, html string"
sha = lambda b: hashlib.sha256(b).hexdigest()

# Main text.


@pytest.mark.parametrize(
    ("page", "blocks"),
    [
        (None, []),
        ("", []),
        ("plain text", [("plain text", 1)]),
        ("<p>a<b>b</b>c<br>d\n\n e&amp;f &lt;x&gt; &#233;&nbsp;&#x41; &am &ampx", [("abc d e&f <x> é A &am &x", 1)]),
        ("<nav><ul><li><a href='/'>Home</a><li>Two</ul></nav><article><h1>T</h1><p>One<p>Two</article><footer>f</footer>", [("Home", 2), ("Two", 2), ("T", 0), ("One", 0), ("Two", 0), ("f", 2)]),
        ("<head><title>t</title></head><script>var a='<p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><p>yes", [("yes", 1)]),
        ("<article><p>a</p><div class='ad-box'>buy</div><aside>s</aside><section id=comments><article><p>c</p></article></section><form>f<input></form></article>", [("a", 0), ("buy", 2), ("s", 2), ("c", 2), ("f", 2)]),
        ("<div class='wrap has-sidebar'><article class='post comments-open'>x</article></div><div class='sidebar'>y</div>", [("x", 0), ("y", 2)]),
        ("<form id=aspnet><article>x</article><p>rest</form>", [("x", 0), ("rest", 2)]),
        ("<main><div>a</div><nav>n</nav></main><div>o</div>", [("a", 0), ("n", 2), ("o", 1)]),
        ("<div class='sidebar'><div class='content'>s</div></div><div id=content><p>a</p><div class=adbox>b</div></div><p>o", [("s", 2), ("a", 0), ("b", 2), ("o", 1)]),
        ("<div class='widget'><div class='entry-content'>a</div></div><div class=content>b</div>", [("a", 0), ("b", 0)]),
        ("<header><h1>Site</h1></header><article><header><h1>Head</h1></header>t</article>", [("Site", 2), ("Head", 0), ("t", 0)]),
        ("<div class=cookie-notice>c</div><div role=navigation>n</div><p>3 < 4 and 5 > 4", [("c", 2), ("n", 2), ("3 < 4 and 5 > 4", 1)]),
        ("<p title='a>b'>x</p><p title=\"un>y", [("x", 1), ("y", 1)]),
        ("<table><tr><td>a<td>b<tr><td>c</table>z<torn", [("a", 1), ("b", 1), ("c", 1), ("z", 1)]),
        ("<p>a<!-- open <p>b", [("a", 1)]),
        ("x<noscript>n</noscript><svg><text>s</text></svg>y</div></p>z", [("xy", 1), ("z", 1)]),
    ],
)
def test_blocks(page, blocks):
    assert pages.blocks_of(page) == blocks


def test_hostile_pages_take_linear_time():
    for page in ("<" * 300_000, "<a " * 200_000, '<a "' * 100_000 + ">", "<div>" * 50_000 + "x", "<!--" * 100_000, "&" * 300_000, "<p><li>" * 50_000, "<b>" * 100_000 + "</i>" * 100_000, "<script>" * 50_000):
        pages.blocks_of(page)


def plain_repeats(rows, run):
    """Covered tokens of each row's stream, from all substrings of all pages of a host."""
    parsed = [(re.sub(r"^.*?://([^/?#]*).*$", r"\1", u).lower() if u and "://" in u else "", pages.blocks_of(h)) for _, u, h in rows]
    where = defaultdict(set)
    windows = []
    for host, blocks in parsed:
        parts, _ = html_text.stream_of(blocks)
        own, at = [], 0
        for p in parts:
            n = min(run, len(p))
            own += [(tuple(p[i : i + n]), at + i) for i in range(len(p) - n + 1)]
            at += len(p)
        windows.append(own)
        for w, _ in own:
            where[host, w].add(tuple(t for t, _ in blocks))
    return [{p for w, at in own if len(where[host, w]) > 1 for p in range(at, at + len(w))} for (host, _), own in zip(parsed, windows, strict=True)]


def plain_text(html, covered):
    blocks = pages.blocks_of(html)
    _, starts = html_text.stream_of(blocks)
    out, whole = [], []
    for (text, kind), start in zip(blocks, starts, strict=True):
        if kind == pages.FURNITURE:
            continue
        whole.append(text)
        if kind == pages.OPEN:
            text = " ".join(w for i, w in enumerate(text.split(" ")) if start + i not in covered)
        if text:
            out.append(text)
    return "\n".join(out or whole)


def test_host_suffix_array(spark):
    rng = random.Random(2)
    line = lambda n: " ".join(f"w{rng.randrange(60)}" for _ in range(n))
    menus, notes = [line(12) for _ in range(3)], [line(9) for _ in range(3)]
    rows = []
    for i in range(60):
        host = ("a.com", "B.com", "c.com")[i % 3]
        body = f"<div>{menus[i % 3]}</div>" + (f"<article><p>{line(30)}</p><p>{notes[i % 3]}</p></article>" if i % 2 else f"<div>{line(20)}</div><p>{notes[i % 3]} {line(4)}</p>")
        rows.append((i, f"http://{host}/{i}?x#y", f"<html><body>{body}<p>{menus[i % 3][::-1]} x{i}</p><div>foot</div>"))
    rows += [(70, "http://a.com/copy", rows[0][2]), (70, "http://a.com/copy", rows[0][2]), (None, "http://a.com/p", "<p>" + line(30)), (71, None, f"<p>{menus[0]}"), (72, "nothing", f"<p>{menus[0]}</p>u"), (73, "http://a.com/e", None), (74, "http://a.com/f", "")]
    rows += [(80, "http://d.com/", f"<p>{(near := line(40))}"), (81, "http://d.com/", f"<p>{near} end"), (82, "http://e.com/", "<p>" + "é " * 20_000)]
    df = spark.createDataFrame(rows, PAGES).withColumn("host", F.lit(1)).withColumn("text", F.lit("clash")).repartition(6)
    covered = plain_repeats(rows, html_text.RUN)
    want = Counter((p, u, plain_text(h, c), len(plain_text(h, c)), len(c)) for (p, u, h), c in zip(rows, covered, strict=True))
    got = Counter((r.page_id, r.url, r.text, r.n_chars, r.n_repeated) for r in html_text.extract_text(df).collect())
    assert got == want
    text = {r[0]: r[2] for r in got}
    assert menus[0] not in text[0] and menus[0] not in text[3]  # boilerplate goes
    assert notes[1] in text[1]  # but stays in main text
    assert text[80] == near  # near copies keep their text
    assert html_text.extract_text(df.limit(0)).collect() == []
    small = html_text.extract_text(df, run=4).collect()
    assert Counter((r.page_id, r.n_repeated) for r in small) == Counter((p, len(c)) for (p, _, _), c in zip(rows, plain_repeats(rows, 4), strict=True))
    with pytest.raises(ValueError):
        html_text.extract_text(df, run=6)


# Fill-in-the-middle.


def plain_form(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = sha(f"1:{'' if doc_id is None else doc_id}".encode())
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, sha(text.encode()), sha(text.encode())
    out = f"<S>{s}<P>{p}<M>{m}" if h[3] % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, "spm" if h[3] % 100 < 20 else "psm", len(p), len(m), sha(out.encode()), sha(text.encode())


def test_forms(spark):
    rng = random.Random(7)
    texts = [None, "", "a", "é", "<P>", "x <M> y", "word", "w" * 70_000 + " tail", " " * 5_000, "日本語 text\n\r\t mixed", "a" * 300 + "é" * 300 + "b c " * 500]
    texts += [" ".join("q" * rng.choice((1, 3, 8, 700)) + rng.choice(("", "é", "!")) for _ in range(rng.randrange(1, 400))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id here"), (3, "é"), (3, "é"), (-5, "negative id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("form", F.lit(1)).withColumn("h1", F.lit(2)).repartition(4)
    got = Counter(tuple(r) for r in infill.digest_forms(infill.transform(df)).collect())
    assert got == Counter(plain_form(*r) for r in rows)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert infill.digest_forms(infill.transform(df.limit(0))).collect() == []


def test_rank_index_is_exact_and_bounded():
    rng = random.Random(3)
    texts = ["", "y" * 100_000 + " z" * 700 + "é" * 900, " ".join("w" * rng.randrange(1, 500) for _ in range(2_000)), "", "a b " * 3_000]
    raw = [t.encode() for t in texts]
    data, offs = np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw]))
    at, first = infill.boundaries(data, offs)
    index = infill.fit(at, first, offs)
    assert np.abs(index.residual.astype(int)).max() <= infill.EPSILON
    for d, t in enumerate(texts):
        want = np.append(0, np.cumsum([len(u.encode()) for u in re.findall(r"[A-Za-z]+|[^A-Za-z]", t)])).astype(int) + offs[d]
        assert (index.offset(np.full(len(want), d), np.arange(len(want))) == want).all()
    even = np.searchsorted(index.rank, index.first)
    assert even[-1] < len(index.rank) - 10  # even text: a segment for 256 ranks
    assert len(index.rank) - even[-1] <= 12_000 // 200
    with pytest.raises(ValueError):
        infill.fit(at, first, offs, epsilon=128)
    for kind in ("psm", "spm", "plain"):
        assert infill.restore(kind, infill.form(kind, b"a", b"b", b"c")) == b"abc"
    with pytest.raises(ValueError):
        infill.restore("psm", b"abc")


# Conversation repair.

GOOD = re.compile(r"(s?(ua)+)?\Z")


def plain_least(codes):
    """The cheapest audit by trying every sequence of edits (two insertions in a row at most)."""
    best = None
    for acts in itertools.product(*[("D",) if c == 0 else ("D", "K", "R") for c in codes]):
        for added in itertools.product(range(3), repeat=len(codes) + 1):
            cost, letters, ways = 0, "", [""]
            for c, act, more in zip([*codes, None], [*acts, None], added, strict=True):
                letters += "I" * more
                cost += 2 * more
                for _ in range(more):
                    ways = [w + x for w in ways for x in "ua"]
                if act is None:
                    continue
                letters += act
                if act == "D":
                    cost += 3
                    continue
                cost += (c - 1) % 2 + 2 * (act == "R")
                ways = [w + x for w in ways for x in ("ua" if act == "R" else "sua-"[(c - 1) // 2])]
            if any(GOOD.match(w) for w in ways) and (best is None or (cost, letters) < best):
                best = cost, letters
    return best


def test_least_audit():
    rng = random.Random(1)
    cases = [list(c) for n in range(3) for c in itertools.product(range(9), repeat=n)] + [[rng.randrange(9) for _ in range(3)] for _ in range(25)]
    for codes in cases:
        assert repair.least_audit(codes) == plain_least(codes), codes


def table_least(codes):
    """The same by a table of whole audits, for longer conversations."""
    best = {0: (0, "")}

    def grow(b):
        for _ in range(3):
            for s, (c, a) in list(b.items()):
                q = repair.STEP[s][repair.made(s)]
                b[q] = min(b.get(q, (c + 2, a + "I")), (c + 2, a + "I"))
        return b

    for code in codes:
        new = {}
        for s, (c, a) in grow(dict(best)).items():
            ways = [(s, 3, "D")]
            if code:
                ways.append((repair.STEP[s][repair.made(s)], 2 + (code - 1) % 2, "R"))
                if (i := "sua-"[(code - 1) // 2]) in repair.STEP[s]:
                    ways.append((repair.STEP[s][i], (code - 1) % 2, "K"))
            for q, more, x in ways:
                new[q] = min(new.get(q, (c + more, a + x)), (c + more, a + x))
        best = new
    end = grow(dict(best))
    return min(end[s] for s in (0, 3) if s in end)


def test_divide_and_conquer():
    rng = random.Random(5)
    for _ in range(150):
        codes = [rng.choice([0, 1, 3, 3, 4, 5, 5, 6, 7, 8]) for _ in range(rng.randrange(33, 300))]
        assert repair.least_audit(codes) == table_least(codes)


def plain_repair(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        own = by[conv]
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        own += [(turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    out = []
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], sha(r[2].encode())))
        faults, codes, seen = [0, 0, 0], [], set()
        for _, role, text in own:
            kept = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = 0 if not kept else 1 if (role, text) in seen else 2 if kept[-1] not in ".!?" else 3
            seen.add((role, text))
            if fault < 3:
                faults[fault] += 1
            codes.append(repair.code_of(role[:1], fault == 2, fault < 2))
        turns = [t for t, _, _ in own if t is not None]
        cost, audit = table_least(codes)
        state, lines, left = "", [], iter(own)
        for x in audit:
            made = "assistant" if state.endswith("u") else "user"
            _, role, text = (None, made, "") if x == "I" else next(left)
            if x == "D":
                continue
            role = made if x == "R" else role
            state += role[:1]
            lines.append(f"{role}:{text}")
        assert GOOD.match(state)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        out.append((conv, len(own), max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *faults, illegal, cost, audit, sha("\n".join(lines).encode())))
    return Counter(out)


def test_repair(spark):
    rng = random.Random(11)
    say = lambda: rng.choice(["Yes.", "no", "", "  ", "What? ", "a.\n", None, "é!", "long " * 50 + "."])
    rows = []
    for conv in range(120):
        for turn in range(rng.randrange(0, 9)):
            rows.append((conv, turn, ("user", "assistant")[turn % 2] if rng.random() < 0.7 else rng.choice(["system", "tool", "", None, "Assistant"]), say()))
    rows += [(500, t, rng.choice(["user", "assistant"]), say() if rng.random() < 0.5 else f"{t}.") for t in range(700)]
    rows += [(None, 1, "user", "x."), (None, None, "user", "y."), (501, None, "assistant", "z."), (501, None, None, None), (502, 3, "user", "same."), (502, 3, "user", "same."), (502, 3, "assistant", "other."), (503, 10**12, "user", "far"), (503, 1, "system", "near.")]
    rows += [(c, 0, "user", "only.") for c in range(600, 660)]  # some are dropped whole
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("audit", F.lit(1)).withColumn("d", F.lit(2)).repartition(5)
    got = Counter(tuple(r) for r in repair.repair_conversations(repair.damage(df)).collect())
    assert got == plain_repair(rows)
    assert any(r[1] == 0 and r[-1] == sha(b"") for r in got)
    assert repair.repair_conversations(repair.damage(df.limit(0))).collect() == []


def test_queries_are_registered():
    for name in ("op11_html_text", "op12_fill_in_middle", "op13_conversation_repair"):
        assert name in queries.QUERIES and name in llm_sql.SQL


# Earlier operators: what this round added to them.


def test_equal_texts_share_a_shard(spark):
    rng = random.Random(4)
    rows = [(i, f"text {i} " + "x" * rng.randrange(200), ("en", "de", None)[i % 3], f"s{i % 7}") for i in range(600)]
    rows += [(1000 + i, f"copied {i % 40} " + "y" * (i % 40), ("en", "fr")[i % 2], f"s{i % 5}") for i in range(240)]
    rows += [(2000 + i, None, None, None) for i in range(5)] + [(3000, "", "en", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    for keep in (None, ["doc_id", "text", "lang", "source"]):
        got = shards.shard_documents(docs, 8, keep=keep).collect()
        per = Counter(r.shard for r in got)
        assert len(got) == len(rows) and max(per.values()) - min(per.values()) <= 1
        text = {d: t or "" for d, t, *_ in rows}
        where = defaultdict(set)
        for r in got:
            where[text[r.doc_id]].add(r.shard)
        assert sum(len(w) > 1 for w in where.values()) <= 7  # borders


def old_record(kind, name, block, version=b"WARC/1.0", extra=b"", colon=b": "):
    head = [version, b"WARC-Type" + colon + kind, b"WARC-Record-ID" + colon + name, b"WARC-Date: 2011-02-25T18:32:19Z", b"Content-Length" + colon + str(len(block)).encode()]
    return b"\r\n".join(head) + b"\r\n" + extra + b"\r\n" + block + b"\r\n\r\n"


def test_other_archives_are_read(spark, tmp_path):
    """WARC/1.0 and 1.1, other record types and ids, folded headers, base-32 digests, gzip members, and magics in payloads."""
    import base64
    import gzip

    html = b"<p>WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n</p>"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    again = hashlib.sha1(b"zzz").digest()
    records = [
        old_record(b"warcinfo", b"<urn:uuid:0>", b"software: x\r\nformat: WARC File Format 1.0\r\n"),
        old_record(b"request", b"<urn:uuid:1>", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", extra=b"WARC-Target-URI: http://a/\r\n"),
        old_record(b"response", b"<urn:uuid:2>", http + html, extra=b"WARC-Target-URI:http://a/\r\nX-Long: one\r\n two\r\n", colon=b":"),
        old_record(b"metadata", b"<urn:uuid:3>", b"fetchTimeMs: 3\r\n\r\n", b"WARC/1.1"),
        old_record(b"revisit", b"<urn:uuid:4>", b"", extra=b"WARC-Refers-To: <urn:uuid:2>\r\nWARC-Payload-Digest: sha1:" + base64.b32encode(again) + b"\r\n"),
        old_record(b"response", b"<urn:page:77>", http + b"plain", b"WARC/1.1"),
        old_record(b"resource", b"<urn:uuid:5>", "é".encode() * 900),
    ]
    h = lambda b: hashlib.sha1(b).hexdigest()
    want = Counter(
        [
            ("warcinfo", None, "urn:uuid:0", h(b"software: x\r\nformat: WARC File Format 1.0\r\n"), None), ("request", None, "urn:uuid:1", h(b""), None), ("response", None, "urn:uuid:2", h(html), None),
            ("metadata", None, "urn:uuid:3", h(b"fetchTimeMs: 3\r\n\r\n"), None), ("revisit", None, "urn:uuid:4", again.hex(), "urn:uuid:2"), ("response", 77, "urn:page:77", h(b"plain"), None), ("resource", None, "urn:uuid:5", h("é".encode() * 900), None),
        ]
    )
    for name, data in (("plain.warc", b"".join(records)), ("whole.warc.gz", gzip.compress(b"".join(records))), ("members.warc.gz", b"".join(map(gzip.compress, records)))):
        folder = tmp_path / name.replace(".", "-")
        folder.mkdir()
        (folder / name).write_bytes(data)
        got = warc.read_archives(spark, f"file://{folder}").collect()
        assert Counter((r.record_type, r.page_id, r.record_id, r.payload_digest, r.refers_to_id) for r in got) == want
        assert {r.target_uri for r in got} == {None, "http://a/"}
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "x.warc").write_bytes(b"".join(records)[:-10])
    with pytest.raises(ValueError, match="chain"):
        warc.read_archives(spark, f"file://{tmp_path}/cut").collect()


def test_links_of_pages_without_url_and_base_addresses(spark):
    rules = [("block", "bad.com/"), ("allow", "good.org/")]
    link = '<link rel="canonical" href="{}">'
    rows = [
        (1, None, link.format("http://bad.com/x")), (2, None, link.format("http://bad.com/x")), (3, None, link.format("/nowhere")), (4, None, "<p>"), (5, None, link.format("http://good.org/") + link.format("http://bad.com/x2")),
        (6, "http://a.net/d/p", '<base href="http://bad.com/dir/">' + link.format("q")), (7, "http://b.net/d/p", '<base href="/e/">' + link.format("q")), (8, "http://b.net/e/q", link.format("http://bad.com/z")), (9, "http://c.net/", '<base target="_top">' + link.format("q")),
        (10, None, link.format("http://d.net/1") + link.format("http://bad.com/y")), (11, "http://d.net/1", ""),
    ]
    got = {r.page_id: r.verdict for r in urls.judge_urls(spark.createDataFrame(rows, PAGES), rules).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "block", 7: "block", 8: "block", 9: "allow", 10: "block", 11: "block"}


def test_classes_on_a_generated_graph(spark):
    """Redirect classes of random pages against a plain union of links."""
    rng = random.Random(6)
    hosts = [f"h{i}.net" for i in range(60)] + ["bad.com", "x.bad.com", "good.org"]
    rows, links = [], []
    for i in range(150):
        host, to = hosts[i % len(hosts)], rng.choice(hosts)
        url = f"http://{host}/{i % 4}"
        html = "" if rng.random() < 0.4 else f'<meta http-equiv="refresh" content="0; url=//{to}/{rng.randrange(4)}">'
        rows.append((i, url, html))
        if html:
            links.append((url[7:], html.split("url=//")[1][:-2]))
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    said = defaultdict(set)
    judge = lambda place: "block" if (h := place.split("/")[0]) == "bad.com" or h.endswith(".bad.com") else "allow" if h == "good.org" else None
    for place in list(root):
        said[find(place)].add(judge(place))
    want = {i: judge(u[7:]) or ("block" if "block" in said[find(u[7:])] and "allow" not in said[find(u[7:])] else "allow") for i, u, _ in rows}
    got = {r.page_id: r.verdict for r in urls.judge_urls(spark.createDataFrame(rows, PAGES), [("block", "bad.com/"), ("allow", "good.org/")]).collect()}
    assert got == want and len(set(want.values())) == 2
