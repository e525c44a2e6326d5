"""Strings on which polynomial hashes collide, rows without ids or with repeated ones, clashing columns, and bounds that no longer exist."""

from __future__ import annotations

import gzip
import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lamina.llm import _io, chat, decontaminate, mixing, ngram_join, quality, queries, shards, substrings, tokens, urls, warc
from tests.llm import test_operators as plain_versions
from tests.llm.test_operators import DOCS, WORD2, corpus, words


def thue_morse(a: str, b: str, n: int) -> str:
    one, two = a, b
    while len(one) < n:
        one, two = one + two, two + one
    return one[:n]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "en", "s", 0) for r in rows], DOCS)


@pytest.mark.parametrize("n", [1024, 8192])
def test_words_and_lines_that_fool_polynomials(spark, n):
    x, y = thue_morse("a", "b", n), thue_morse("b", "a", n)
    rest = " one two three four five six seven eight nine"
    rows = [(0, x), (1, y), (2, x + rest), (3, y + rest), (4, f"{x} {y}\n{y} {x}\n{x} {y}"), (5, x + y), (6, y + x), (7, None)]
    docs = frame(spark, rows)
    items = spark.createDataFrame([(1, x), (2, x + rest), (None, y + rest)], "item_id long, text string")
    found = {r.doc_id: (r["items"], r.unnamed, r.spans) for r in decontaminate.find_contamination(docs, items).collect()}
    assert found[0] == ([1], False, [0, 1]) and found[1] == ([], False, []) and found[2] == ([1, 2], False, [0, 10]) and found[3] == ([], True, [0, 10])
    stats = {r.doc_id: r for r in quality.document_statistics(docs).collect()}
    assert stats[4].n_dup_lines == 1 and stats[4].n_repeat_words == 0 and stats[4].n_distinct == 2
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = {d: len(t.encode(s or "", add_special_tokens=False)) for d, s in rows}
    assert {r.doc_id: r.n_tokens for r in tokens.count_tokens(docs, P.path("byte_bpe_50k.json")).collect()} == want
    plain_versions.test_ngram_join(spark, [(*r, "en", "s", 0) for r in rows], docs)
    assert {r.doc_id: tuple(r)[1:] for r in substrings.remove_repeats(docs).collect()} == removal([(d, s) for d, s in rows])


def removal(rows, length=100):
    """{id: result} or [(id, result)]: a string goes if a smaller id has it, or the row itself earlier."""
    least: dict[bytes, float] = {}
    texts = [(float("inf") if d is None else d, (t or "").encode()) for d, t in rows]
    for d, b in texts:
        for i in range(len(b) - length + 1):
            k = b[i : i + length]
            least[k] = min(d, least.get(k, float("inf")))
    out = []
    for (d, _), (key, b) in zip(rows, texts):
        gone, own = bytearray(len(b)), set()
        for i in range(len(b) - length + 1):
            k = b[i : i + length]
            if least[k] < key or k in own:
                gone[i : i + length] = b"\1" * length
            own.add(k)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1])), hashlib.sha256(kept).hexdigest()))
    ids = [d for d, _ in rows]
    return {d: tuple(r) for d, *r in out} if len(set(ids)) == len(ids) else sorted(out, key=repr)


@pytest.mark.parametrize("hot", [8192, 2])
def test_substrings_of_repeated_and_missing_ids(spark, hot):
    rng = random.Random(4)
    common = words(rng, 60)
    rows = [(7, "a" * 300), (7, words(rng, 70)), (7, "a" * 120), (None, "b" * 300), (None, words(rng, 80)), (None, "b" * 150 + common), (7, None), (None, None), (None, ""), (3, common), (9, common + words(rng, 9)), (9, words(rng, 9) + common), (9, "a" * 130)]
    rows += [(None, common + " " + words(rng, 30)) for _ in range(12)] + [(20, words(rng, 40) + common)] * 3
    docs = frame(spark, rows).repartition(3)
    assert sorted((tuple(r) for r in substrings.remove_repeats(docs, hot).collect()), key=repr) == removal(rows)
    # Nulls are spread over groups by their text.
    placed, _ = substrings._repeats(docs, hot)
    assert placed.filter("missing").select("doc", "sub").distinct().count() == len({t or "" for d, t in rows if d is None})


def test_missing_ids(spark):
    rng = random.Random(6)
    text = words(rng, 90)
    rows = [(None, text), (None, text), (5, text), (4, text + " more"), (None, words(rng, 70)), (None, None), (5, words(rng, 60))]
    docs = frame(spark, rows)
    bench = spark.createDataFrame([(1, " ".join(text.split()[:14]))], "item_id long, text string")
    found = decontaminate.find_contamination(docs, bench).collect()
    assert Counter((r.doc_id, len(r["items"])) for r in found) == Counter({(None, 1): 2, (None, 0): 2, (5, 1): 1, (5, 0): 1, (4, 1): 1})
    assert sorted((r.doc_id is None, r.text or "") for r in decontaminate.clean_documents(docs, bench).collect()) == sorted((d is None, t or "") for d, t in rows if not (t or "").startswith(text))
    got = ngram_join.duplicate_classes(docs).collect()
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter({(None, None): 4, (5, 4): 1, (4, 4): 1, (5, 5): 1})
    assert len(quality.judge_documents(docs, None).collect()) == len(rows)
    P = pytest.importorskip("public_tokenizers")
    assert Counter(r.doc_id for r in tokens.count_tokens(docs, P.path("byte_bpe_50k.json")).collect()) == Counter(d for d, _ in rows)
    placed = shards.shard_documents(docs, shards=3).collect()
    assert Counter(r.doc_id for r in placed) == Counter(d for d, _ in rows) and {len([r for r in placed if r.shard == s]) for s in range(3)} <= {2, 3}
    mixed = mixing.mix_documents(docs, group=2, fan=2).collect()
    assert Counter((r.doc_id, r.size) for r in mixed) == Counter((d, len((t or "").split())) for d, t in rows)


def test_near_misses_of_many_sizes(spark):
    """Dense sets over several classes of sizes, whose members share a long passage and aren't all alike."""
    rng = random.Random(12)
    base = words(rng, 300).split(" ")
    rows = []
    for i in range(170):
        own = [f"o{i}_{k}" for k in range(rng.randrange(0, 90))]
        rows.append((i, " ".join(own + base[: rng.choice([300, 300, 270, 240])]), "en", "s", 0))
    plain_versions.test_ngram_join(spark, rows, spark.createDataFrame(rows, DOCS))


def test_one_phrase_of_very_many_items(spark):
    docs = frame(spark, [(1, "x a b c d e f g h i j y"), (2, "nothing of it")])
    items = spark.createDataFrame([(k, "a b c d e f g h i j" + (f" own{k}" if k % 2 else "")) for k in range(500)], "item_id long, text string")
    for block in (200_000, 3):
        got = {r.doc_id: r for r in decontaminate.find_contamination(docs, items, block=block).collect()}
        assert got[1]["items"] == list(range(500)) and got[1].spans == [1, 11] and got[2]["items"] == []


def test_links_of_every_kind(spark):
    rules = [("allow", "org/"), ("block", "com/de/")]
    link, refresh = '<link rel="canonical" href="{}">', '<meta http-equiv="refresh" content="0; url={}">'
    data = [
        (1, "http://a.net/x/start.html", link.format("next.html")), (2, "http://a.net/x/next.html", refresh.format("http://b.com/de/1")),
        (3, "http://c.net/list", link.format("?p=2")), (4, "http://c.net/list?p=2", link.format("http://b.com/de/2")),
        (5, "http://d.net/a/b/c", link.format("../x")), (6, "http://d.net/a/x", link.format("http://free.net/") + refresh.format("//b.com/de/3")),
        (7, "http://e.net/", link.format("http://f.net/?a=1&amp;b=2&#x26;c=&#51;")), (8, "http://f.net/?a=1&b=2&c=3", link.format("#here") + link.format("http://b.com/de/4")),
        (9, "http://free.net/other", "<p>canonical refresh</p>"), (10, None, None),
    ]
    got = {r.page_id: r.verdict for r in urls.judge_urls(spark.createDataFrame(data, "page_id long, url string, html string"), rules).collect()}
    assert got == {k: "allow" if k in (9, 10) else "block" for k in range(1, 11)}


def test_rules_as_a_table(spark):
    rng = random.Random(8)
    hosts = ["a.com", "b.a.com", "c.b.a.com", "x.org", "org", "y.x.org", "net"]
    rules = list({r: (rng.choice(["allow", "block"]), r) for r in (f"{rng.choice(hosts)}/{''.join(rng.choice('ab/') for _ in range(rng.randrange(0, 6)))}" for _ in range(3000))}.values())
    assert len(rules) > urls.COMPILED
    data = [(i, f"http://{rng.choice(['', 'w.'])}{rng.choice(hosts)}{rng.choice(['', '/'])}{''.join(rng.choice('ab/') for _ in range(rng.randrange(0, 7)))}", None) for i in range(300)] + [(300, None, None), (301, "x", None)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    want = {}
    for i, u, _ in data:
        host, path = (u.split("://")[1].split("/", 1) + [None])[:2] if u and "://" in u else ("", None)
        path = "" if path is None else "/" + path
        fits = [(len(r), r, v) for v, r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
        want[i] = max(fits)[1:] if fits else (None, "allow")
    for given in (rules, spark.createDataFrame([(v, r) for v, r in rules], "verdict string, rule string")):
        assert {r.page_id: (r.rule, r.verdict) for r in urls.judge_urls(pages, given).collect()} == want


def test_templates_run_over_conversations(spark):
    rows = spark.createDataFrame([(1, 0, "a", "x"), (1, 1, "b", "y"), (2, 0, "a", "z")], "conv_id long, turn long, role string, text string")
    for template, want in (
        ("BEGIN {% for m in messages %}[{{ m.text }}]{% endfor %} END", {1: "BEGIN [x][y] END", 2: "BEGIN [z] END"}),
        ("{% for m in messages %}{{ m.role }}{% endfor %}:{% for m in messages %}{{ m.text }}{% endfor %}", {1: "ab:xy", 2: "a:z"}),
        ("{% for m in messages %}{% for n in messages %}{{ n.text }}{% endfor %};{% endfor %}", {1: "xy;xy;", 2: "z;"}),
        ("{% if messages %}some{% endif %}", {1: "some", 2: "some"}), ("none", {1: "none", 2: "none"}),
    ):
        for part in (1 << 22, 2):
            got = chat.format_conversations(rows, template, part).collect()
            assert {c: "".join(r.text for r in sorted((r for r in got if r.conv_id == c), key=lambda r: r.part)) for c in (1, 2)} == want
    assert chat.takes_stream(chat.fold(chat.parse(chat.TEMPLATE)))


def test_archives_in_ranges_and_members(spark, tmp_path):
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 4\r\n\r\nHTTP\r\n\r\n"
    rng = random.Random(3)
    html = {i: (fake * rng.randrange(1, 5) + "é" * rng.randrange(40)) if i % 5 == 0 else words(rng, rng.randrange(1, 300)) for i in range(120)}
    pages = spark.createDataFrame([(i, f"http://h/{i}", t) for i, t in html.items()], "page_id long, url string, html string").repartition(2)
    want = {i: (len(t.encode()), hashlib.sha1(t.encode()).hexdigest()) for i, t in html.items()}
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "2000")
        warc.write_archives(pages, f"{tmp_path}/plain")
        assert {r.page_id: (r.payload_bytes, r.payload_digest) for r in warc.read_archives(spark, f"{tmp_path}/plain").collect()} == want
    finally:
        spark.conf.set(key, before)
    (tmp_path / "gz").mkdir()
    for k, part in enumerate(sorted((tmp_path / "plain").glob("part-*"))):
        raw, out = part.read_bytes(), b""
        for at in range(0, len(raw), 777):  # members end anywhere
            out += gzip.compress(raw[at : at + 777])
        (tmp_path / "gz" / f"{k}.warc.gz").write_bytes(out)
    assert {r.page_id: (r.payload_bytes, r.payload_digest) for r in warc.read_archives(spark, f"{tmp_path}/gz").collect()} == want
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "x.warc").write_bytes(raw[:-5])
    with pytest.raises(ValueError, match="end of"):
        warc.read_archives(spark, f"{tmp_path}/cut")


def test_many_values_are_ranked_and_files_pruned(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, "t" * (1 << rng.randrange(12)), rng.choice("abcdefgh"), f"s{rng.randrange(15_000):05d}", 0) for i in range(20_000)]
    docs = spark.createDataFrame(rows, DOCS)
    steps = {r["_value"]: r["step"] for r in shards.rank_steps(docs, "source", 5).collect()}
    assert len(steps) > 10_000 and [steps[s] for s in sorted(steps)] == sorted(steps.values()) and set(steps.values()) == set(range(32))
    shards.write_shards(shards.shard_documents(docs), f"{tmp_path}/out")
    shards.write_shards(shards.cut_runs(docs.select("doc_id", "source", "lang", (F.length("text") + 8).alias("_size")), ["doc_id"], 24), f"{tmp_path}/plain")

    def read(where: str, test: str) -> int:
        """Files whose minima and maxima can't rule the test out."""
        files = spark.read.parquet(f"{tmp_path}/{where}").groupBy(F.input_file_name().alias("f")).agg(F.min("source").alias("lo"), F.max("source").alias("hi"), F.min("_size").alias("small"), F.max("_size").alias("big"))
        return files.filter(test).count(), files.count()

    for test in ("lo <= 's01000' and hi >= 's00900'", "small <= 600 and big >= 520"):
        some, every = read("out", test)
        assert every >= 24 and 3 * some <= 2 * every
        plain, all_plain = read("plain", test)
        assert 10 * plain >= 9 * all_plain  # in the order of ids hardly a file can be skipped
    assert 4 * read("out", "lo <= 's01000' and hi >= 's00900' and small <= 600 and big >= 520")[0] <= every


def test_more_sources_than_are_broadcast(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, words(rng, rng.randrange(1, 30)), "en", f"s{rng.randrange(40)}", 0) for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS)
    want = {r.doc_id: r for r in mixing.mix_documents(docs).collect()}
    monkeypatch.setattr(mixing, "FEW_SOURCES", 3)
    assert {r.doc_id: r for r in mixing.mix_documents(docs).collect()} == want
    size, taken = Counter(), Counter()
    for r in want.values():
        size[r.source] += r.size
        taken[r.source] += r.taken
    assert all(r.target <= 3 * size[r.source] + 1e-6 and abs(taken[r.source] - r.target) <= 30 for r in want.values())
    assert abs(sum({r.source: r.target for r in want.values()}.values()) - sum(size.values())) < 1e-6


def test_repeated_rows_mix_as_rows(spark):
    rows = [(1, "one two three", "en", "a", 0)] * 300 + [(None, "four five", "en", "b", 0)] * 200 + [(2, "six", "en", "c", 0)] * 100
    got = mixing.mix_documents(spark.createDataFrame(rows, DOCS), group=16, fan=4).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter({(1, 3): 300, (None, 2): 200, (2, 1): 100})
    for s in "abc":
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 3


def test_threshold_comes_from_held_out_rows(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(900):
        good = i % 3 > 0
        rows.append((i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "word", "text"]) + str(rng.randrange(400)) if good else rng.choice(["###", "$$$", "x1", "9999", "y"]) + str(rng.randrange(40)) for _ in range(120)), "en", "s", 0))
        labels.append((i, int(good), 0))
    docs, marked = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    trees = quality.train(docs, marked)
    r = trees.report
    assert r["rows"] + r["held_out"] == 900 and 120 < r["held_out"] < 240 and r["held_out_accuracy"] > 0.95 and r["good_kept"] > 0.99 and r["bad_rejected"] > 0.9


def test_clashing_columns_elsewhere(spark):
    P = pytest.importorskip("public_tokenizers")
    rows = corpus(3, 20)
    docs = spark.createDataFrame(rows, DOCS)
    wide = docs
    for c in ("n_bytes", "n_tokens", "score", "kept", "quality", "key", "pos", "windows", "no", "_n", "missing", "sub", "small", "apart", "_value", "step"):
        wide = wide.withColumn(c, F.lit("x"))
    labels = spark.createDataFrame([(d, int(len((t or "").split()) > 50), 0, "z") for d, t, *_ in rows], "doc_id long, quality int, toxic int, text string")
    plain = lambda df: sorted(map(tuple, df.collect()), key=repr)
    trees = quality.train(wide, labels)
    assert plain(quality.judge_documents(wide, trees)) == plain(quality.judge_documents(docs, quality.train(docs, labels)))
    path = P.path("byte_bpe_50k.json")
    assert plain(tokens.count_tokens(wide, path)) == plain(tokens.count_tokens(docs, path))
    assert plain(substrings.remove_repeats(wide)) == plain(substrings.remove_repeats(docs))
    assert plain(mixing.mix_documents(wide)) == plain(mixing.mix_documents(docs))
    assert plain(ngram_join.duplicate_classes(wide)) == plain(ngram_join.duplicate_classes(docs))
    assert plain(shards.shard_documents(wide).select("doc_id", "shard", "slot")) == plain(shards.shard_documents(docs).select("doc_id", "shard", "slot"))
    pages = spark.createDataFrame([(1, "http://a.com/de/1", '<link rel="canonical" href="/x">', "p", 1, 2), (2, "http://a.com/x", "h", "p", 3, 4)], "page_id long, url string, html string, host string, root int, file int")
    assert {r.page_id: r.verdict for r in urls.judge_urls(pages, [("block", "com/de/")]).collect()} == {1: "block", 2: "block"}
    assert {r.page_id: r.payload_bytes for r in warc.archive_round_trip(pages).collect()} == {1: 32, 2: 1}
    talk = spark.createDataFrame([(1, 0, "user", "t", 5, "m")], "conv_id long, turn long, role string, text string, part int, marks string")
    assert chat.digest_formatted(chat.format_conversations(talk)).first().n_turns == 1
    clean = decontaminate.clean_documents(wide.withColumn("_hit", F.lit(1)), spark.createDataFrame([(1, "two words")], "item_id long, text string"))
    assert clean.columns == [*wide.columns, "_hit"] and 0 < clean.count() < len(rows)
    odd = wide.withColumn("_of", F.lit(1)).withColumn("_copies", F.lit(2)).withColumn("_copy", F.lit(3))
    for f in (ngram_join.drop_duplicates, mixing.take_copies):
        assert f(odd).columns == odd.columns and f(odd).count() == f(docs).count() > 0


def test_registered_queries(spark, tmp_path):
    """The thin queries against plain versions of what their contracts say."""
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    rows = corpus(7, 25)
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d, int(len((t or "").split()) > 60), 0) for d, t, *_ in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    run = lambda n: {r.doc_id: r for r in queries.QUERIES[n](spark, str(tmp_path)).collect()}
    two, three, six, seven, eight = (run(n) for n in ("op2_quality", "op3_token_counts", "op6_shards", "op7_mixing", "op8_substrings"))
    t, text = Tokenizer.from_file(P.path("byte_bpe_50k.json")), {d: x or "" for d, x, *_ in rows}
    for d, x in text.items():
        n = len(WORD2.findall(x))
        assert two[d].n_words == n and two[d].base_failed == (n < 50 or 100 * two[d].n_repeat_words > 50 * n) and not (two[d].base_failed and two[d].kept)
        want = len(t.encode(x, add_special_tokens=False))
        assert (three[d].n_bytes, three[d].n_tokens, three[d].over_limit) == (len(x.encode()), want, want > 1024)
        assert (six[d].size, six[d].text_crc32, six[d].law, six[d].grown_shard) == (len(x.encode()) + 8, zlib.crc32(x.encode()), "rows", None) and 0 <= six[d].shard < 24
        assert seven[d].size == n and seven[d].taken <= 3 * n
    assert {d: tuple(r)[1:] for d, r in eight.items()} == removal([(d, x) for d, x, *_ in rows])
    per = Counter(r.shard for r in six.values())
    assert max(per.values()) - min(per.get(s, 0) for s in range(24)) <= 1


def test_running_totals(spark):
    df = spark.createDataFrame([(k, v) for k, v in zip("ddacbb", (4, 5, 1, 3, 2, 2))], "k string, v long")
    got = {(r.k, r.v, r.before) for r in _io.running(df, ["k", "v"], "v", "before").collect()}
    assert got == {("a", 1, 0), ("b", 2, 1), ("b", 2, 3), ("c", 3, 5), ("d", 4, 8), ("d", 5, 12)}
    assert [r.pos for r in _io.running(df, ["k", "v"]).orderBy("k", "v").collect()] == list(range(6))
    assert _io.running(df.limit(0), ["k"]).count() == 0
