"""Corpus operators against brute force, and on awkward input."""

import gzip
import hashlib
import random
import re
import zlib

import pytest

import corpus_pipeline
from gridloom.llm import (components, decontaminate, html_text, mixing, near_dup, pii, quality_model, quality_rules,
                          rlz, sharding, warc)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, failed string, size string"
SMALL = "/root/testdata/sf0.001"


def words(text):
    return (text or "").encode().split()


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randrange(60))
                    for _ in range(n))


@pytest.fixture(scope="module")
def awkward(spark):
    """Null, empty and long texts, ties, repeated rows, odd white space, clashing column names."""
    base = prose(80, 1)
    rows = [(1, base), (2, base), (2, base), (3, None), (4, ""), (5, " \t\n"), (6, base + " tail"), (None, base),
            (7, prose(30000, 2)), (8, "one two"), (9, prose(40, 3) + "\n" + prose(40, 3)), (10, "ÀÉ ñandú 你好 " * 30),
            (11, "a b  c" * 20), (12, prose(12, 4)), (13, prose(13, 4))]
    return spark.createDataFrame([(i, t, "en", None if i == 4 else f"s{(i or 0) % 3}", None, "x", "y") for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def empty(awkward):
    return awkward.filter("false")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.read.parquet(f"{SMALL}/benchmark.parquet")


def test_empty_tables(spark, empty, bench):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    model = quality_model.train(empty, labels)
    for out in (quality_rules.ledger(empty), sharding.shard_by_bytes(empty, 3), decontaminate.leaks(empty, bench),
                mixing.mix(empty), html_text.extract_text(pages), near_dup.classes(empty), near_dup.keep_one(empty),
                rlz.remove_duplicate_spans(empty), rlz.factors(empty), pii.find_personal_data(empty),
                quality_model.score(empty, model), warc.with_record_types(pages)):
        assert out.count() == 0


def test_stages_keep_columns(spark, awkward, empty):
    """Each stage takes awkward rows and returns the columns of its input; the last assigns every row."""
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, SMALL).columns == awkward.columns
        out = stage(spark, awkward, SMALL)
        assert out.columns == awkward.columns, name
        assert {r.doc_id for r in out.collect()} <= {r.doc_id for r in awkward.collect()}
    assert corpus_pipeline.STAGES[-1][1](spark, awkward, SMALL).count() == awkward.count()


def test_rules(awkward):
    found = quality_rules.apply_policy(quality_rules.ledger(awkward)).collect()
    texts = {r.doc_id: r.text for r in awkward.collect()}
    for r in found:
        text = texts[r.doc_id] or ""
        w = words(text)
        assert r.n_words == len(w) and r.word_chars == sum(len(x.decode()) for x in w)
        lines = [x for x in text.encode().split(b"\n") if x.split()]
        assert r.n_dup_lines == len(lines) - len(set(lines))
        runs = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
        twice = {x for x in runs if runs.count(x) > 1} if len(w) < 1000 else set()
        if len(w) < 1000:
            assert r.n_repeat_words == len({i + k for i, x in enumerate(runs) if x in twice for k in range(8)})
            assert r.base_failed == (len(w) < 20 or 100 * r.n_repeat_words > 30 * len(w))
        assert not (r.base_failed and r.kept)
    assert len(found) == awkward.count()


def test_ablations_follow_bits(docs):
    policy = quality_rules.CURRENT
    entries = quality_rules.ledger(docs)
    failed = [r.failed & policy.mask for r in entries.collect()]
    for r in quality_rules.ablations(entries).collect():
        assert r.failed_docs == sum(1 for f in failed if f & r.bit)
        assert r.only_this_docs == sum(1 for f in failed if f == r.bit)


def test_shards(awkward):
    for shards in (1, 3, 24):
        rows = sorted(sharding.shard_by_bytes(awkward, shards).collect(),
                      key=lambda r: (r.doc_id is not None, r.doc_id or 0, r["size"], r.text_crc32))
        total, at = sum(r["size"] for r in rows), 0
        slots = {}
        for r in rows:
            assert r.shard == min((2 * at + r["size"]) * shards // (2 * total), shards - 1)
            assert r.law == "bytes" and r.grown_shard is None
            slots.setdefault(r.shard, []).append(r.slot)
            at += r["size"]
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = {r.doc_id: (r.text or "").encode() for r in awkward.collect()}
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id]) and r["size"] == len(texts[r.doc_id]) + 8 for r in rows)


def test_decontamination(spark, bench):
    items = [(r.item_id, r.text) for r in bench.collect()]
    rng = random.Random(5)
    rows, want = [], set()
    for n, (item, text) in enumerate(items):
        w = text.split()
        for _ in range(decontaminate.edits_allowed(len(re.findall(r"\w+", text))) * (n % 2)):
            w[rng.randrange(len(w))] = f"changed{n}"
        rows.append((n, prose(200, n) + " " + " ".join(w).upper() + " " + prose(50, n + 1)))
        want.add((n, item))
    rows += [(9000, prose(400, 99)), (9001, None), (9002, "")]
    found = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want
    clean = decontaminate.keep_clean(spark.createDataFrame(rows, "doc_id long, text string"), bench)
    assert {r.doc_id for r in clean.collect()} == {9000, 9001, 9002}
    none = spark.createDataFrame([(None, None), (1, ""), (2, "two words")], "item_id long, text string")
    assert decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), none).count() == 0


def _edited_items(n_words, count, seed):
    """Items, and texts that hold each of them with as many edits as are allowed."""
    rng = random.Random(seed)

    def draw(k):
        return [f"w{rng.randrange(50000)}" for _ in range(k)]

    items, texts = [draw(n_words) for _ in range(count)], []
    for item in items:
        w = list(item)
        for _ in range(decontaminate.edits_allowed(n_words)):
            at, new = rng.randrange(len(w)), f"e{rng.randrange(10**9)}"
            w[at:at + rng.randrange(2)] = [new] * rng.randrange(2)
        texts.append(" ".join(draw(rng.randrange(200)) + w + draw(rng.randrange(200))))
    return [(i, " ".join(w)) for i, w in enumerate(items)], texts


@pytest.mark.parametrize("n_words, count", [(60, 200), (300, 40), (1600, 20)])
def test_long_items_are_found(n_words, count):
    rows, texts = _edited_items(n_words, count, n_words)
    found = decontaminate.find([*texts, prose(3000, 3)], decontaminate.prepare(rows))
    assert [[f["item_id"] for f in x] for x in found] == [[i] for i in range(count)] + [[]]
    assert all(f["edits"] <= decontaminate.edits_allowed(n_words) for x in found for f in x)


def test_items_beyond_the_target_go_by_triples(monkeypatch):
    rows, texts = _edited_items(40, 150, 7)
    monkeypatch.setattr(decontaminate, "MOST", decontaminate.PER_EMBEDDING)
    items = decontaminate.prepare([*rows, (999, "five words of no text")])
    assert len(items.classes) == 1 and sum(len(set(owners)) for _, owners in items.exact) == 150
    found = decontaminate.find(texts, items)
    assert [[f["item_id"] for f in x] for x in found] == [[i] for i in range(150)]
    # At the very start and end of a text, and twice in one.
    edge = [rows[0][1], f"{rows[1][1]} {rows[0][1]} {rows[1][1]}", ""]
    assert [[f["item_id"] for f in x] for x in decontaminate.find(edge, items)] == [[0], [0, 1], []]


def test_mixing(awkward, docs):
    for table in (awkward, docs):
        rows = mixing.mix_with_plan(table).select("row.doc_id", "row.source", "epoch", "source_plan.*").collect()
        taken = {(r.doc_id, r.source) for r in rows}
        assert taken == {(r.doc_id, r.source) for r in table.collect()}
        ratio = max(r.passes for r in rows)
        assert ratio <= mixing.REPETITION_LIMIT + 1e-6
        assert abs(sum({r.source: r.weight for r in rows}.values()) - 1) < 1e-6


def test_mixing_meets_budget(spark):
    rows = [(i, "w " * 10, "big" if i % 10 else "small") for i in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan, _ = mixing.plan(table, target_entropy=2.0, limit=3.0)
    passes = {r.mix_source: r.passes for r in plan.collect()}
    assert passes["=big"] == pytest.approx(1) and passes["=small"] == pytest.approx(3, abs=1e-3)
    out = mixing.mix(table, target_entropy=2.0, limit=3.0).collect()
    assert abs(sum(1 for r in out if r.source == "small") - 900) <= 2
    assert sum(1 for r in out if r.source == "big") == 2700


def test_warc_round_trip(spark, tmp_path):
    page = "<p>" + "x" * 200
    rows = [(3, "http://a/", page), (1, None, page), (2, "http://b/\r\nWARC-Type: x", "WARC/1.1\r\n\r\nnot a record\r\n\r\n" * 9),
            (4, "u", None), (5, "u", ""), (6, "u", "é" * 90), (7, "u", "é" * 90), (None, "u", page), (8, "u", "short"), (9, "u", "short")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, payload string")
    for compression in ("gzip", "none"):
        path = str(tmp_path / compression)
        warc.write_archives(pages, path, compression)
        back = warc.read_archives(spark, path).collect()
        assert all(r.kind == "record" for r in back) and len(back) == len(rows)
        got = {r.page_id: r for r in back}
        for page_id, _, html in rows:
            payload = (html or "").encode()
            r = got[page_id]
            assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
            assert r.record_type == "revisit" or r.payload == payload
        assert {k for k, r in got.items() if r.record_type == "revisit"} == {None, 3, 7}
        assert got[3].refers_to == 1 and got[7].refers_to == 6 and got[1].refers_to is None


def _record(n, payload):
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{n}>\r\nContent-Length: {len(payload)}\r\n"
    head += f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}\r\n\r\n"
    return head.encode() + payload + b"\r\n\r\n"


def test_salvage():
    plain = [_record(n, b"payload %d " % n * 40) for n in range(6)]
    damaged = bytearray(b"".join(plain))
    damaged[len(plain[0]) + len(plain[1]) // 2] ^= 0xFF
    items = list(warc.read_archive(bytes(damaged) + b"trash"))
    assert [i.headers["warc-record-id"] for i in items if i.kind == "record"] == [f"<urn:page:{n}>" for n in (0, 2, 3, 4, 5)]
    gaps = [i for i in items if i.kind == "gap"]
    assert [(g.offset, g.length) for g in gaps] == [(len(plain[0]), len(plain[1])), (sum(map(len, plain)), 5)]
    members = [gzip.compress(r, mtime=0) for r in plain]
    broken = bytearray(members[2])
    broken[len(broken) // 2] ^= 0x55
    data = members[0] + members[1] + bytes(broken) + members[3] + members[4][:-9]
    items = list(warc.read_archive(data))
    assert {0, 1, 3} <= {int(i.headers["warc-record-id"][10:-1]) for i in items if i.kind == "record"}
    assert any(i.kind == "gap" and i.offset == len(members[0]) + len(members[1]) for i in items)
    assert list(warc.read_archive(b"")) == []


def test_html():
    page = ("<html><body class='x'><nav><a href=/>home</a></nav><div class='cookie-notice'>take it</div><article><h1>A &amp; B</h1>"
            "<p>First <b>bold</b>\n text<br>next<p>Second one here, longer than the rest of it all.</article>"
            "<aside>side</aside><section id=comments><p>I think</p></section><form>ask</form><script>if (a<b) x('</p>')</script>"
            "<footer>end</footer></body></html>")
    assert html_text.main_text(page) == "A & B First bold text next Second one here, longer than the rest of it all."
    two = "<body><div><h2>x</h2><p>" + "word " * 90 + "</p></div><div><p>" + "more " * 90 + "</p></div></body>"
    assert html_text.main_text(two).count("word") == 90 and html_text.main_text(two).count("more") == 90
    for odd in ("", "<", "<p", "</p></p>", "plain", "<!-- x", "<script>", "<p title='>", "<b>" * 3000 + "deep", "&#xZZ;&amp"):
        assert isinstance(html_text.main_text(odd), str)
    assert html_text.main_text("plain") == "plain" and html_text.main_text("<nav>only</nav>") == ""


def test_html_keeps_the_whole_article():
    def p(letter, *sizes):
        return "".join(f"<p>{letter * n}</p>" for n in sizes)

    def found(page):
        return html_text.main_text(page).split()

    assert found(f"<article>Lead text <b>bold</b><div>{p('x', 300, 300)}</div>tail</article>") == [
        "Lead", "text", "bold", "x" * 300, "x" * 300, "tail"]
    title = f"<h1>{'t' * 30}</h1><div>{p('x', 300, 300, 300)}</div>"
    for page in (f"<article>{title}</article>", f"<main><div class=wrap>{title}</div></main>", f"<body>{title}</body>",
                 f"<article><div><div>{title}</div></div></article>", f"<body><font>{title}</font></body>"):
        assert found(page) == ["t" * 30, *["x" * 300] * 3], page
    sections = f"<section>{p('x', 300, 300, 300, 300)}</section><section><h2>second</h2>{p('y', 300, 250, 150)}</section>"
    for name in ("article", "main", "body", "div"):
        assert found(f"<{name}>{sections}</{name}>") == [*["x" * 300] * 4, "second", "y" * 300, "y" * 250, "y" * 150]
    links = "<ul><li><a href=/1>one thing</a><li><a href=/2>other thing</a></ul>"
    assert "thing" not in found(f"<body>{links}<article>{title}<nav>menu</nav></article>{links}</body>")
    assert found(f"<body>{links}<article>{title}<div>{links}</div></article></body>").count("thing") == 2
    assert found(f"<body><h1><a href=/1>linked</a> <a href=/2>title</a></h1><div>{p('x', 300, 300)}</div>{links}</body>")[:2] == ["linked", "title"]


def test_html_table(spark):
    pages = spark.createDataFrame([(1, None, None, "c"), (None, "u", "<p>é 你</p>", "c"), (1, None, None, "c")],
                                  "page_id long, url string, html string, text string")
    got = sorted((r.text, r.n_chars) for r in html_text.extract_text(pages).collect())
    assert got == [("", 0), ("", 0), ("é 你", 3)]


def test_near_duplicates_awkward(awkward):
    got = [(r.doc_id, r.class_id) for r in near_dup.classes(awkward).collect()]
    assert len(got) == awkward.count()
    classes = dict(got)
    assert classes[2] == classes[6] == 1 and classes[4] == 3 and classes[5] == 5 and classes[None] is None
    kept = [r.doc_id for r in near_dup.keep_one(awkward).collect()]
    assert sorted(k for k in kept if k is not None) == sorted({c for c in classes.values() if c is not None})


def test_components(spark):
    links = [(n, n + 1) for n in range(1, 40)] + [(100, 50 + n) for n in range(30)] + [(7, 7)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert {got[n] for n in range(1, 41)} == {1} and {got[n] for n in [100, *range(50, 80)]} == {50}


def _kept(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    first = {}
    for i, t in order:
        w = words(t)
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k:k + 13]), i)
    out = []
    for i, t in order:
        w = words(t)
        keep = [True] * len(w)
        for k in range(len(w) - 12):
            lead = first[tuple(w[k:k + 13])]
            if lead is not None and (i is None or lead < i):
                keep[k:k + 13] = [False] * 13
        left = [x for x, k in zip(w, keep) if k]
        out.append((i, len(w), len(w) - len(left), hashlib.sha256(b" ".join(left)).hexdigest()))
    return out


def test_substrings(spark, docs, awkward):
    for table in (docs, awkward):
        rows = [(r.doc_id, r.text) for r in table.collect()]
        got = [tuple(r) for r in rlz.remove_duplicate_spans(table).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()]
        assert sorted(got, key=repr) == sorted(_kept(rows), key=repr)


def test_factors_are_copies(spark):
    shared = prose(40, 8)
    rows = [(1, shared + " " + prose(30, 9)), (2, prose(20, 10) + " " + shared), (3, prose(20, 11))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.start, r.n_words) for r in rlz.factors(table).collect()]
    assert got == [(2, 20, 40)]


def test_personal_data(spark):
    rows = {
        1: ("mail a.b@c-d.org, 10.0.0.255 or 256.1.1.1 +1 (415) 555-2671, card 4111 1111 1111 1111", 4),
        2: ("write john [at] example (dot) com", 1), 3: ("john dot doe at example dot org", 1),
        4: ("call +one four one five five five five two six seven one", 1), 5: ("jоhn@exаmple.com", 1),
        6: ("４１１１ 1111 1111 1111", 1), 7: ("we met at the dot, one or two of us", 0), 8: ("", 0), 9: (None, 0),
        10: ("4111 1111 1111 1112", 0), 11: ("192 dot 168 dot 0 dot 12", 1),
    }
    table = spark.createDataFrame([(i, t, "x") for i, (t, _) in rows.items()], "doc_id long, text string, spans string")
    for r in pii.find_personal_data(table).collect():
        text, n = rows[r.doc_id]
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert len(spans) == n, (text, r.spans)
        base = pii.listing({k: pii.matches(text or "", k) for k in pii.KINDS})
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(base.split(",")) - {""} <= set(r.spans.split(","))
    assert pii.redact_text("x john [at] example (dot) com y") == "x [email] y"
    assert [(s, e) for s, e in pii.spans("jоhn@exаmple.com!")[1]["email"]] == [(0, 16)]


@pytest.mark.parametrize("kind, text", [
    ("ip", "one nine two dot one six eight dot one dot one"), ("ip", "192.168.one.one"),
    ("ip", "one nine two . one six eight . one . one"), ("ip", "one nine two. one six eight. one. one"),
    ("ip", "one nine two [dot] 168 (dot) oneone dot 2"), ("ip", "10.zero.0 dot one"),
    ("phone", "plus four four, two zero, seven nine four six, zero nine five eight"),
    ("phone", "plus one (five five five) one two three, four five six seven"),
    ("phone", "+44 (two zero) 7946\nzero nine five eight"), ("phone", "+ four four two zero seven nine four six 0958"),
    ("card", "four one one one one one one one\none one one one one one one one"),
    ("card", "four one one one, 1111 (1111) one one one one"), ("card", ", ".join(["four", *["one"] * 15])),
    ("card", ".".join(["four", *["one"] * 15])), ("card", "411111111111111 one"),
])
def test_spelled_numbers(kind, text):
    for around in ("{}", "see {}. Thanks", "at one of them,\n\n{};\n\ntwo of us", "é {} x"):
        whole = around.format(text)
        start = whole.index(text)
        assert (start, start + len(text)) in pii.spans(whole)[1][kind], whole
    assert re.fullmatch(r"(\[(ip|card|phone)\])+", pii.redact_text(text))


def test_number_words_of_prose_stay():
    for text in ("One. Two. Three. Four.", "1. one 2. two 3. three 4. four", "one, two, three, four, five", "two plus two",
                 "nine nine nine dot one dot one dot one", "four one one one\n\n" + "one " * 12, "someone dot twofold dot one dot nine"):
        assert not any(pii.spans(text)[1].values()), text
    found = pii.spans("plus one four one five five five five two six seven one, two of us")[1]
    assert found["phone"] == [(0, len("plus one four one five five five five two six seven one"))]
    assert pii.spans("room one 192.168.one.one")[1]["ip"] == [(9, 24)]


def test_rewriting_keeps_offsets():
    text = "a​b " + "１" * 3 + " [at] end"
    out = pii.rewrite(text)
    assert out.text == "ab 111@end"
    assert all(text[lo:hi] for lo, hi in zip(out.lo, out.hi)) and text[out.lo[6]:out.hi[6]] == " [at] "


def test_quality_model(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = quality_model.train(docs, labels)
    rows = quality_model.score(docs, model).join(labels, "doc_id").filter("held_out").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert sum(g > b for g in good for b in bad) > 0.97 * len(good) * len(bad)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert abs(model.attention(rows and b"some words " * 500).sum() - 1) < 1e-6


def test_quality_model_awkward(spark, awkward):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, 0), (99, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.filter("quality = 1"), labels.filter("false")):
        rows = quality_model.score(awkward, quality_model.train(awkward, some)).collect()
        assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
        held = {r.doc_id: r.held_out for r in rows}
        assert all(h == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1) for i, h in held.items())


def test_gradient():
    import numpy as np
    rng = np.random.default_rng(0)
    w = {"E": rng.normal(size=(6, 4)), "e": rng.normal(size=4), "V": rng.normal(size=(4, 3)), "U": rng.normal(size=(4, 3)),
         "k": rng.normal(size=3), "c": rng.normal(size=4), "d": np.array(0.3)}
    x, bags, y = rng.normal(size=(7, 6)), np.array([3, 1, 3]), np.array([1.0, 0.0, 1.0])

    def loss(v):
        out = quality_model._forward(v, x, bags)["out"]
        return np.mean(np.log1p(np.exp(-out * (2 * y - 1))))

    grads = quality_model._gradient(w, x, bags, y)
    for name in w:
        step = np.zeros_like(w[name])
        step.flat[0] = 1e-6
        numeric = (loss({**w, name: w[name] + step}) - loss({**w, name: w[name] - step})) / 2e-6
        assert numeric == pytest.approx(np.asarray(grads[name]).flat[0], abs=1e-6)
