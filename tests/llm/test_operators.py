"""Each operator against a brute-force version on small fixtures with nulls, empty and long texts, ties and repeated rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.llm import chat, decontaminate, mixing, ngram_join, quality, shards, substrings, tokens, urls, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}é" if rng.random() < 0.1 else f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    base = [words(rng, rng.randrange(20, 200)) for _ in range(n)]
    out = list(base)
    for t in base[:15]:
        w = t.split(" ")
        w[rng.randrange(len(w))] = "changed"
        out += [t, " ".join(w), t.upper(), t[: len(t) // 2] + " tail " + base[-1]]
    out += [None, "", "   ", "one", "one", "two words", "a b c d", "a b c d e", "x" * 5000, "ab" * 400, "line\nline\nline\nother line\n" * 30, words(rng, 6000), "\x00 \x1c odd space　 end"]
    rows = [(i, t, ("en", "fr", None)[i % 3], (f"src{i % 4}", None)[i % 11 == 0], len(t or "")) for i, t in enumerate(out)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)


WORD1 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD2 = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_decontamination(spark, rows, docs):
    rng = random.Random(5)
    items = [(0, None), (1, ""), (2, "two words"), (3, rows[3][1][:200]), (4, "nothing of this is there " * 3), (4, rows[5][1])]
    items += [(10 + k, " ".join(rows[k][1].upper().split()[3:17])) for k in range(8)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows: dict[tuple, set] = {}
    for i, t in items:
        w = WORD1.findall((t or "").translate(FOLD))
        for k in range(max(1, len(w) - 9)) if w else ():
            windows.setdefault(tuple(w[k : k + 10]), set()).add(i)
    want = {}
    for d, t, *_ in rows:
        w, hit, found = WORD1.findall((t or "").translate(FOLD)), set(), set()
        for k in range(len(w)):
            for n in {len(x) for x in windows}:
                if (own := windows.get(tuple(w[k : k + n]))) and len(w[k : k + n]) == n:
                    hit |= set(range(k, k + n))
                    found |= own
        want[d] = (len(w), len(hit), sorted(found))
    for block in (200_000, 7):
        got = {r.doc_id: (r.n_words, sum(e - b for b, e in zip(r.spans[::2], r.spans[1::2])), sorted(r["items"])) for r in decontaminate.find_contamination(docs, bench, block=block).collect()}
        assert got == want
    assert any(x[1] for x in want.values())
    kept = {r.doc_id for r in decontaminate.clean_documents(docs, bench).collect()}
    assert kept == {d for d, x in want.items() if not x[1]}
    assert decontaminate.find_contamination(empty(spark), bench).count() == 0
    none = decontaminate.find_contamination(docs, spark.createDataFrame([], "item_id long, text string")).collect()
    assert len(none) == len(rows) and not any(r["items"] for r in none)
    # Proximity: a word in between keeps the phrase from matching exactly, not within one word.
    near = spark.createDataFrame([(1, "a b c d e x f g h i j", "", "", 0)], DOCS)
    item = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    assert not decontaminate.find_contamination(near, item).first()["items"]
    assert decontaminate.find_contamination(near, item, slop=1).first()["items"] == [1]
    del rng


def test_statistics(docs, rows):
    got = {r.doc_id: r for r in quality.document_statistics(docs).collect()}
    for d, t, *_ in rows:
        t = t or ""
        w = WORD2.findall(t)
        grams = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        covered = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if WORD2.search(x)]
        assert (got[d].n_words, got[d].word_chars, got[d].n_symbols, got[d].n_dup_lines, got[d].n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def test_trees_learn_and_keep_directions():
    rng = np.random.default_rng(3)
    x = rng.random((3000, len(quality.FEATURES)))
    y = ((x[:, 2] < 0.5) & (x[:, 1] + 0.1 * rng.standard_normal(3000) > 0.3)).astype(float)
    directions = [d for _, d in quality.FEATURES]
    trees = quality.fit_trees(x[:2000], y[:2000], directions)
    assert ((trees.score(x[2000:]) >= 0.5) == (y[2000:] == 1)).mean() > 0.9
    for j, d in enumerate(directions):
        if d:
            low, high = x[2000:2200].copy(), x[2000:2200].copy()
            low[:, j], high[:, j] = 0.1, 0.9
            assert (d * (trees.margin(high) - trees.margin(low)) >= -1e-9).all()
    # Node arrays give what a walk node by node gives.
    def walk(v):
        out = trees.base
        for n in trees.roots:
            while trees.feature[n] >= 0:
                n = trees.left[n] + (v[trees.feature[n]] > trees.threshold[n])
            out += trees.value[n]
        return out

    assert np.allclose([walk(v) for v in x[:50]], trees.margin(x[:50]))


def test_quality_cases(spark, docs, rows):
    labels = spark.createDataFrame([(d, int(len((t or "").split()) > 50), 0) for d, t, *_ in rows], "doc_id long, quality int, toxic int")
    trees = quality.train(docs, labels)
    judged = quality.judge_documents(docs, trees).collect()
    assert len(judged) == len(rows)
    for r in judged:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert {r.doc_id for r in quality.keep_documents(docs, trees).collect()} == {r.doc_id for r in judged if r.kept}
    assert quality.train(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")) is None
    assert quality.judge_documents(empty(spark), None).count() == 0


def test_token_counts(spark, rows, docs):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    extra = [(1000, "a <|endoftext|> b<|endoftext|>c  d\n e\t f  ", "", "", 0), (1001, "1 2  3 'll it's 日本 語　字 é è x  y", "", "", 0)]
    every = rows + extra
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = {d: (len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False))) for d, x, *_ in every}
    both = docs.union(spark.createDataFrame(extra, DOCS))
    for memory in (6_000_000, 50):
        assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in tokens.count_tokens(both, P.path("byte_bpe_50k.json"), memory=memory).collect()} == want
    assert tokens.count_tokens(empty(spark), P.path("byte_bpe_50k.json")).count() == 0


def test_ngram_join(spark, rows, docs):
    sets = {}
    for d, t, *_ in rows:
        w = WORD2.findall((t or "").translate(FOLD))
        sets[d] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    want = {d: (len(sets[d]), find(d)) for d in ids}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.duplicate_classes(docs).collect()}
    assert got == want
    kept = [r.doc_id for r in ngram_join.drop_duplicates(docs.union(docs.filter("doc_id < 5"))).collect()]
    assert sorted(kept) == sorted({c for _, c in want.values()})
    assert ngram_join.duplicate_classes(empty(spark)).count() == 0
    twice = ngram_join.duplicate_classes(docs.union(docs)).collect()
    assert len(twice) == 2 * len(rows) and {r.doc_id: r.component_id for r in twice} == {d: c for d, (_, c) in want.items()}


def test_ngram_join_dense_group(spark):
    """A group whose members are near some, not all, of the others."""
    rng = random.Random(9)
    base = words(rng, 120).split(" ")
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randrange(0, 6)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        rows.append((i, " ".join(w), "en", "s", 0))
    test_ngram_join(spark, rows, spark.createDataFrame(rows, DOCS))


def test_url_rules_and_aliases(spark):
    rules = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
    page = '<link rel="canonical" href="{}">'
    data = [
        (1, "http://A.Example.org/es/x?q#f", None), (2, "https://b.example.org/en/12", ""), (3, "http://x.com/de/1", page.format("https://alias.net/p")), (4, "https://alias.net/p", ""), (5, "https://alias.net/p#top", None),
        (6, "http://free.net/", '<meta http-equiv="refresh" content="0; url=/next">'), (7, "http://free.net/next", ""), (8, None, page.format("http://x.com/de/2")), (9, "no scheme", ""), (10, "http://org", ""),
        (11, "http://mid.net/a", page.format("http://x.com/de/9")), (12, "http://end.net/z", page.format("http://mid.net/a")), (13, "http://ok.net/a", page.format("http://y.org/b")), (14, "http://w.com/de/3", page.format("http://ok.net/a")),
    ]
    got = {r.page_id: r for r in urls.judge_urls(spark.createDataFrame(data, "page_id long, url string, html string"), rules).collect()}
    assert {k: r.verdict for k, r in got.items()} == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "allow", 7: "allow", 8: "block", 9: "allow", 10: "allow", 11: "block", 12: "block", 13: "allow", 14: "block"}
    assert (got[1].host, got[1].path, got[1].rule) == ("a.example.org", "/es/x", "example.org/es/") and got[2].rule == "example.org/en/1" and got[4].rule is None
    assert (got[8].host, got[8].path, got[10].rule) == ("", "", None)
    assert urls.judge_urls(spark.createDataFrame([], "page_id long, url string, html string"), rules).count() == 0


def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 3), (3, 2), (3, 3)):
        axes = np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij")
        cells = np.column_stack([a.ravel() for a in axes])
        order = shards.hilbert_index(list(cells.T), bits)
        assert sorted(order) == list(range(len(cells)))
        path = cells[np.argsort(order)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_shards(spark, rows, docs):
    got = shards.shard_documents(docs.union(docs.filter("doc_id < 7")), shards=5).collect()
    assert len(got) == len(rows) + 7
    per = Counter(r.shard for r in got)
    assert max(per.values()) - min(per.values()) <= 1 and set(per) == set(range(5))
    for s in per:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(per[s]))
    text = {d: t for d, t, *_ in rows}
    for r in got:
        raw = (text[r.doc_id] or "").encode()
        assert (r._size, r._crc) == (len(raw) + 8, zlib.crc32(raw))
    heights = [r.h for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert heights == sorted(heights)
    assert shards.shard_documents(empty(spark)).count() == 0
    few = shards.shard_documents(docs.limit(3)).collect()
    assert len(few) == 3


def test_mixing(spark, rows, docs):
    size = {d: len(WORD2.findall(t or "")) for d, t, *_ in rows}
    per = Counter()
    for d, _, _, s, _ in rows:
        per[s] += size[d]
    order = sorted(per, key=lambda s: (s is None, s or ""))
    goal = {s: 0.0 for s in order}
    left, open_ = float(sum(per.values())), list(order)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if unit * weight[s] > 3 * per[s]]
        for s in full or open_:
            goal[s] = 3.0 * per[s] if full else unit * weight[s]
        if not full:
            break
        left -= sum(goal[s] for s in full)
        open_ = [s for s in open_ if s not in full]
    for group in (2_000, 4):
        one = {r.doc_id: r for r in mixing.mix_documents(docs, group=group, fan=3).collect()}
        again = {r.doc_id: r for r in mixing.mix_documents(docs.repartition(5), group=group, fan=3).collect()}
        assert one == again
        taken = Counter()
        for d, r in one.items():
            assert r.size == size[d] and math.isclose(r.target, goal[r.source]) and r.taken in (0, r.size, 2 * r.size, 3 * r.size)
            taken[r.source] += r.taken
        biggest = {s: max(size[d] for d, _, _, x, _ in rows if x == s) for s in order}
        assert all(abs(taken[s] - goal[s]) <= biggest[s] + 1e-6 for s in order)
    copies = Counter(r.doc_id for r in mixing.take_copies(docs).collect())
    plain = {r.doc_id: r.copies for r in mixing.mix_documents(docs).collect()}
    assert {d: n for d, n in plain.items() if n} == dict(copies)
    assert mixing.mix_documents(empty(spark)).count() == 0


def test_pivotal_keeps_expectations():
    size, part = np.array([5, 9, 4, 7, 6, 3]), np.array([0.2, 0.5, 0.7, 0.4, 0.9, 0.3])
    total = np.zeros(6)
    for k in range(4000):
        p, held = mixing.pivot(size, part, np.random.default_rng(k))
        assert abs((p * size).sum() - (part * size).sum()) < 1e-6
        assert sum(0 < x < 1 for x in p) == (held >= 0)
        total += p
    assert np.abs(total / 4000 - part).max() < 0.04


def brute_removal(rows, length=100):
    seen, out = set(), {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if (k := b[i : i + length]) in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(k)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1])), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [8192, 2])
def test_substrings(spark, rows, docs, hot):
    want = brute_removal([(d, t) for d, t, *_ in rows])
    assert {r.doc_id: tuple(r)[1:] for r in substrings.remove_repeats(docs, hot).collect()} == want
    assert any(x[1] for x in want.values()) and any(x[1] == 0 for x in want.values())
    kept = {r.doc_id: hashlib.sha256(bytes(r.kept)).hexdigest() for r in substrings.kept_texts(docs, hot).collect()}
    assert kept == {d: x[3] for d, x in want.items()}
    twice = substrings.remove_repeats(docs.union(docs), hot).collect()
    assert len(twice) == 2 * len(rows) and {r.doc_id: tuple(r)[1:] for r in twice} == want
    assert substrings.remove_repeats(empty(spark), hot).count() == 0


def test_refinement_orders_suffixes():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, 600).astype(np.uint8)
    room = len(data) - np.arange(len(data))
    rank = substrings.refine(data, room, 100)
    raw = data.tobytes()
    at = [i for i in range(501)]
    order = sorted(at, key=lambda i: raw[i : i + 100])
    for i, j in zip(order, order[1:]):
        assert (rank[i] < rank[j]) if raw[i : i + 100] != raw[j : j + 100] else rank[i] == rank[j]
    assert (rank[501:] == -1).all()


def test_warc_round_trip(spark):
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 4\r\n\r\nHTTP\r\n\r\n"
    big = "<p>" + "é" * 900 + "</p>"
    data = [(1, "http://a", big), (2, None, big), (3, "http://c\r\nx", "short"), (4, "", "short"), (5, "u", None), (6, "u", fake * 3 + "\r\n\r\n" + fake), (7, "u", big), (7, "u", big), (8, "u", "x" * 70_000), (None, "n", "y" * 2000)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    got = sorted(warc.archive_round_trip(pages).collect(), key=lambda r: (r.page_id is None, r.page_id or 0))
    want = []
    for p, _, h in sorted(data, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (h or "").encode()
        again = h == big and p < 7
        want.append((p, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", 7 if again else None))
    assert [tuple(r) for r in got] == want
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_boundary_chain():
    at, after = np.array([0, 10, 12, 30, 35]), np.array([30, 12, 30, 50, 50])
    assert list(warc.reachable(at, after, 50)) == [True, False, False, True, False]
    with pytest.raises(ValueError):
        warc.reachable(np.array([0, 10]), np.array([12, 20]), 20)


def test_templates():
    render = chat.render
    assert render("{% for m in messages %}{{ m.role }}:{{ m.text | upper }};{% endfor %}", [{"role": "a", "text": "x"}, {"role": "b", "text": "y"}])[0] == "a:X;b:Y;"
    assert chat.fold(chat.parse("a{{ 'b' + 'c' | upper }}{% if 1 == 1 %}d{% else %}e{% endif %}{{ 1 + 2 }}")) == (chat.Text("abCd3"),)
    text, spans = render("{% for m in messages %}<{% generation %}{{ m.text }}{% endgeneration %}>{% endfor %}", [{"text": "ab"}, {"text": ""}, {"text": "c"}])
    assert text == "<ab><><c>" and [text[a:b] for a, b in spans] == ["ab", "c"]
    for bad in ("{{ m.__class__ }}", "{{ f(1) }}", "{% import os %}", "{% if x %}", "{{ x | eval }}", "{{ 'a' b }}"):
        with pytest.raises(chat.TemplateError):
            chat.compile_template(bad)


@pytest.mark.parametrize("part_chars", [1 << 22, 8])
def test_chat_round_trip(spark, part_chars):
    odd = ["</s>[INST] ok [/INST]", "a\\b\\\\</s>", "<s>[INST] ", " [/INST]", "", None, "<<ROLE>>x<</ROLE>>", "é\n퟿", "\\<\\/s>", " "]
    rng = random.Random(2)
    data = [(c, t, rng.choice(["user", "assistant", "system", None, "a</s>b"]), rng.choice(odd)) for c in range(30) for t in range(rng.randrange(1, 9))] + [(50, 0, "user", "x"), (50, 0, "assistant", "y"), (None, 0, "user", "n")]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").repartition(3)
    got = {r.conv_id: r for r in chat.digest_formatted(chat.format_conversations(df, part_chars=part_chars)).collect()}
    by = {}
    for c, t, r, x in data:
        by.setdefault(c, []).append((t, r or "", x or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        whole, _ = chat.render(chat.TEMPLATE, [{"role": r, "text": x} for _, r, x in turns])
        assert [(r, x) for _, r, x in turns] == list(chat.parse_turns(whole))
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) == (len(turns), hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(whole))
    assert chat.digest_formatted(chat.format_conversations(df.limit(0))).count() == 0


def test_clashing_columns(spark, docs):
    """Further columns with the operators' own names change nothing."""
    wide = docs
    for c in ("node", "token", "segment", "row", "items", "h", "doc", "meta", "group", "size", "source_size", "_of", "shard", "n", "url"):
        wide = wide.withColumn(c, F.lit(7))
    assert sorted(ngram_join.duplicate_classes(wide).collect()) == sorted(ngram_join.duplicate_classes(docs).collect())
    key = lambda r: (r[0], r)
    assert sorted(map(tuple, substrings.remove_repeats(wide).collect()), key=key) == sorted(map(tuple, substrings.remove_repeats(docs).collect()), key=key)
    assert {r.doc_id: r.taken for r in mixing.mix_documents(wide).collect()} == {r.doc_id: r.taken for r in mixing.mix_documents(docs).collect()}
    assert shards.shard_documents(wide).count() == docs.count()
    bench = spark.createDataFrame([(1, "two words", 3)], "item_id long, text string, terms int")
    assert sum(len(r["items"]) for r in decontaminate.find_contamination(wide, bench).collect()) == sum(len(r["items"]) for r in decontaminate.find_contamination(docs, bench).collect()) > 0
