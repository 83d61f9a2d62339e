"""Chat formatting, license scan, byte-level BPE, decontamination, sharding and extraction."""

import base64
import random
import re
import struct
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loantide.llm import bpe, chat, decontamination, extraction, licenses, sharding
from loantide.llm.common import words_of
from loantide.llm.queries import rank_file

TURNS = "conv_id long, turn long, role string, text string"
DOCS = "doc_id long, text string"


def test_rendered_turns_read_back():
    random.seed(1)
    parts = ["### User: ", "### Assistant: ", "</turn>", "\n</turn>\n", "\\", "\\\\", "### @x%20y: ", "### ", " ok", "\n", "é", "🎈", "### Tool:", ""]
    turns = [(random.choice(["user", "assistant", "system", "tool", "", "a b:\n", "@", "User", "é%"]),
              "".join(random.choices(parts, k=random.randint(0, 9)))) for _ in range(2_000)]
    whole, bodies = "", []
    for role, text in turns:
        rendered, a, b = chat.render(role, text)
        bodies.append((len(whole) + a, len(whole) + b))
        whole += rendered
    assert chat.parse(whole) == turns
    assert [chat.unescape(whole[a:b]) for a, b in bodies] == [t for _, t in turns]
    plain = chat.render("user", "no control string")[0]
    assert plain == "### User: no control string\n</turn>\n"
    assert chat.parse("### User: x") is None and chat.parse("x") is None and chat.parse("") == []


def test_conversations(spark, monkeypatch):
    rows = [(1, 1, "assistant", "b </turn>"), (1, 0, "user", None), (1, 1, "assistant", "b </turn>"), (None, 5, None, "x"),
            (2, None, "assistant", ""), (2, 3, "odd: role", "long " * 50_000), *[(3, k, "user", f"t{k}") for k in range(500)]]
    df = spark.createDataFrame([(*r, "taken") for r in rows], f"{TURNS}, formatted string").repartition(3)
    got = {r["conv_id"]: r for r in chat.format_turns(df).collect()}
    assert chat.parse(got[1]["formatted"]) == [("user", ""), ("assistant", "b </turn>"), ("assistant", "b </turn>")]
    spans = got[1]["loss_spans"]
    assert [chat.unescape(got[1]["formatted"][s["start"]:s["end"]]) for s in spans] == ["b </turn>"] * 2
    assert chat.parse(got[None]["formatted"]) == [("", "x")] and got[None]["loss_spans"] == []
    assert chat.parse(got[2]["formatted"]) == [("assistant", ""), ("odd: role", "long " * 50_000)]
    assert [t for _, t in chat.parse(got[3]["formatted"])] == [f"t{k}" for k in range(500)] and got[3]["n_turns"] == 500
    assert chat.format_turns(spark.createDataFrame([], TURNS)).count() == 0


def brute_findings(text):
    words = [w.decode() for w in words_of(text)]
    padded = f" {'  '.join(words)} "
    found = []
    for n, priority, label, _, pattern in [*licenses.rules(), *licenses.base_rules()]:
        for m in re.finditer(licenses.on_padded(pattern), padded) if words else ():
            found.append((padded[: m.start()].count(" ") // 2, padded[: m.end()].count(" ") // 2, priority, n, label))
    kept = [f for f in found if not any(g != f and g[0] <= f[0] and g[1] >= f[1] and g[2] <= f[2] and (g[:2] != f[:2] or g[2:4] < f[2:4]) for g in found)]
    return len(words), found, sorted(kept)


def test_license_findings_match_brute_force(spark):
    random.seed(2)
    pieces = ["Licensed under the Apache License, Version 2.0", "CC-BY-SA 4.0", "cc by", "All rights reserved.", "the GNU General Public License v3",
              "GPL-2.0 or later", "MIT License", "mit", "Permission is hereby granted, free of charge", "copyright (c) 2019-2020", "Éa word", "license",
              "https://creativecommons.org/licenses/by-nc/4.0/", "SPDX-License-Identifier: BSD-3-Clause", "general public", "x" * 300, "\n", "cc by cc by"]
    texts = [None, "", " .,;", "CC BY", *(" ".join(random.choices(pieces, k=random.randint(1, 14))) for _ in range(150)), "cc by " * 300]
    df = spark.createDataFrame([(k if k % 9 else None, t, "taken") for k, t in enumerate(texts)], f"{DOCS}, findings string")
    got = licenses.scan(df.withColumn("row", F.monotonically_increasing_id()), ["doc_id", "row"]).orderBy("row").collect()
    first_base = len(licenses.rules())
    assert len(got) == len(texts)
    for text, row in zip(texts, got):
        n, found, kept = brute_findings(text)
        assert row["n_words"] == n
        assert sorted((f["start"], f["stop"], f["priority"], f["rule"], f["label"]) for f in row["findings"]) == kept, text
        assert sorted(f["start"] for f in row["base"]) == sorted(f[0] for f in found if f[3] >= first_base)
    digest = licenses.digest(licenses.scan(df, ["doc_id"]), ["doc_id"])
    assert digest.filter("score < 0 OR score > 1").count() == 0
    assert "PythonUDF" not in digest._jdf.queryExecution().toString() and "Exchange" not in digest._jdf.queryExecution().executedPlan().toString()
    assert licenses.scan(df.limit(0), ["doc_id"]).count() == 0
    assert len(licenses.rules()) >= 200


@pytest.fixture(scope="module")
def reference_encoding():
    tiktoken = pytest.importorskip("tiktoken")
    import public_tokenizers

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(rank_file(), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_matches_the_reference_encoding(reference_encoding):
    random.seed(3)
    texts = ["", "a" * 3_000, "the quick" * 300, "日本語テキスト" * 60, "\x1c\x1d \x85\xa0 \n\n  a", "ªº²½ ¾x", "😀" * 400, "<|endoftext|>", "'s't I'll", "e\u0301à "]
    texts += ["".join(chr(random.choice([random.randint(0, 127), random.randint(0, 255), random.randint(0, 0x2FFF)])) for _ in range(random.randint(1, 80))) for _ in range(400)]
    encoder = bpe.Encoder(open(rank_file(), "rb").read(), bpe.GPT_PATTERN)
    for text, ids in zip(texts, encoder.encode(texts)):
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == reference_encoding.encode_ordinary(text)
        assert encoder.decode(ids) == text.encode()


def test_bpe_frames(spark, reference_encoding):
    rows = [(1, "Hello world", "x"), (1, "Hello world", "x"), (None, None, "x"), (2, "", None), (3, "word " * 40_000, "x")]
    df = spark.createDataFrame(rows, f"{DOCS}, ids string")
    got = bpe.decode(bpe.encode(df, ["doc_id"], "text", rank_file()), ["doc_id"], rank_file()).collect()
    want = Counter((i, (t or "").encode(), len(reference_encoding.encode_ordinary(t or ""))) for i, t, _ in rows)
    assert Counter((r[0], bytes(r["decoded"]), len(r["ids"]) // 4) for r in got) == want
    assert bpe.encode(df.limit(0), ["doc_id"], "text", rank_file()).count() == 0


def test_decontamination_matches_brute_force(spark):
    random.seed(4)
    word = lambda: random.choice(["Ab", "c", "é", "Δx", "7"])
    item_texts = [" ".join(word() for _ in range(random.choice([0, 3, 12, 13, 20, 40]))) for _ in range(25)] + [None, "...", "Q1 q1!"]
    items = [(k if k % 7 else None, t) for k, t in enumerate(item_texts)] + [(1, item_texts[1])]
    texts = [None, "", "--", *(" , ".join(random.choice([word(), *[t for t in item_texts if t]]) for _ in range(random.randint(1, 8))) for _ in range(60))]
    docs = spark.createDataFrame([(k, t, "taken") for k, t in enumerate(texts)] + [(3, texts[3], "taken")], f"{DOCS}, n_words string")
    table = spark.createDataFrame(items, "item_id long, text string")

    def brute(text):
        words, hit, found = words_of(text), set(), set()
        for item, t in items:
            own = words_of(t)
            for k in range(max(1, len(own) - 12) if own else 0):
                window = own[k:k + 13]
                for p in range(len(words) - len(window) + 1):
                    if words[p:p + len(window)] == window:
                        hit |= set(range(p, p + len(window)))
                        found |= set() if item is None else {str(item)}
        return len(words), len(hit), sorted(found)

    for block in (decontamination.BLOCK_CHARS, 400):  # one automaton, and several
        got = decontamination.contamination(docs, table, ["doc_id"], block_chars=block).withColumn("n_hit", decontamination.n_hit()).collect()
        assert len(got) == len(texts) + 1
        for r in got:
            assert (r["n_words"], r["n_hit"], r["item_ids"]) == brute(texts[r["doc_id"]])
            for at, words in zip(r["spans"], r["words_hit"]):
                own = words_of(r["text"][at["start"]:at["end"]])
                assert own == words_of(r["text"])[words["start"]:words["end"]]
    assert decontamination.contamination(docs, table.limit(0), ["doc_id"]).filter("size(spans) > 0").count() == 0
    assert decontamination.contamination(docs.limit(0), table, ["doc_id"]).count() == 0


def test_sharding(spark, folder):
    shards = [f"s{k}" for k in range(10)]
    table = sharding.fill_table(shards, 1_009)
    sizes = Counter(table)
    assert set(sizes) == set(range(10)) and max(sizes.values()) - min(sizes.values()) <= 1
    fewer = sharding.fill_table(shards[:-1], 1_009)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 9)
    assert moved < 0.25 * len(table)
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.fill_table(bad)
    with pytest.raises(ValueError):
        sharding.fill_table(shards, 1_000)
    df = spark.createDataFrame([(k, "x", "old") for k in [*range(500), None, None, 7]], f"{DOCS}, shard string")
    placed = sharding.place(df, "doc_id", shards, 1_009)
    rows = placed.collect()
    assert len(rows) == 503 and all(r["shard"] == shards[table[r["slot"]]] for r in rows)
    assert len({r["shard"] for r in rows if r["doc_id"] is None}) == 1 == len({r["shard"] for r in rows if r["doc_id"] == 7})
    sharding.write_shards(placed, f"{folder}/shards")
    assert spark.read.parquet(f"{folder}/shards").count() == 503
    assert sharding.place(df.limit(0), "doc_id", shards).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p><article>";</script></head><body>
<header class="top"><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">Buy now</div>{body}
<aside>More here</aside><form><p>Sign up</p></form><div class="comments"><p>First!</p></div><footer>&copy; us</footer></body></html>"""


def test_pages():
    article = "<article><h1>Title &amp; more</h1><p><b>Some</b>thing\n  here.<br>Next line<p>Un<i>clos</i>ed &eacute;<!-- x --></article>"
    want = "Title & more Something here. Next line Unclosed é"
    assert extraction.Page(PAGE.format(body=article)).text(None) == want
    plain = '<div class="box"><div class="post-12 body"><p>' + "Long text of the page. " * 9 + "</p><p>Another.</p></div></div>"
    page = extraction.Page(PAGE.format(body=plain))
    assert page.text(None) == ("Long text of the page. " * 9).strip() + " Another."
    assert page.paths[page.best()].endswith("div.body.post-N")
    for empty in (None, "", "<html><body></body></html>", "<!-- never closed", "<script>x"):
        assert extraction.Page(empty).text(None) == ""
    assert extraction.Page("just text < 3 & more").text(None) == "just text < 3 & more"
    assert extraction.Page("<div>" * 3_000 + "deep").text(None) == "deep"


def test_marks_do_not_discard_the_article():
    long = ("Text of the article, sentence by sentence. " * 9).strip()
    part = lambda attributes, tag="div": f"<{tag} {attributes}><p>{long}</p></{tag}>"
    read = lambda body: extraction.Page(PAGE.format(body=body)).text(None)
    for names in ("content-sidebar-wrap", "main has-sidebar", "post category-social", "article comments-open", "text-widget", "sidebar", "tag-ads"):
        for tag in ("div", "article", "main", "section"):
            assert read(part(f'class="{names}"', tag)) == read(part(f'id="{names.split()[0]}"', tag)) == long
    assert read(f'<div class="widget"><div class="ad"><p>Buy.</p></div>{part("", "article")}</div><div class="other"><p>{long} {long}</p></div>') == long
    # One of many posts is no large share of its page, and still none of the parts beside the article.
    assert read('<div class="posts">' + part('class="post category-social"') * 9 + "</div>") == " ".join([long] * 9)
    for names in ("ad", "ad-slot", "site-footer", "cookie-banner", "comment-list", "widget_recent", "sidebar-1"):
        assert read(f'<div class="text">{part("")}<div class="{names}"><p>Other.</p></div></div>') == long


def test_marks_of_blocks():
    long = ("Text of the article, sentence by sentence. " * 9).strip()
    read = lambda body: extraction.Page(PAGE.format(body=f"<article>{body}</article>")).text(None)
    for tag in ("p", "li", "h2", "pre", "dd", "span"):
        assert read(f'<p>{long}</p><{tag} class="notice">Beside.</{tag}><p>After.</p>') == f"{long} After."
        assert read(f'<p>{long}</p><{tag} hidden>Beside.</{tag}><p>After.</p>') == f"{long} After."
    assert read(f'<p class="notice">Beside.<p>{long}') == long
    assert read(f'<ul><li class="ad">Beside.<ul><li>Within</li></ul> too.<li>{long}</ul>') == long
    assert read(f'<p>{long} <span class="share">Share <span>it</span> now</span> and on.</p>') == f"{long} and on."
    assert read(f'<p class="alert">{long}</p><p title="a hidden role">After.</p>') == f"{long} After."


def test_hosts_vote(spark):
    body = lambda text, side: f'<div class="main-1"><p>{text}</p></div><div class="rail"><p>{side}</p></div>'
    rows = [(k, f"http://Host.example/{k}", PAGE.format(body=body("Article text that is long. " * 5, "short"))) for k in range(5)]
    # On this page the rail is longer, but the host's other pages have their text in main.
    rows += [(5, "https://user@host.example:80/x?y", PAGE.format(body=body("Brief.", "A rail that is longer than the article. " * 4)))]
    rows += [(6, None, None), (6, None, None), (7, "no address", "<p>alone"), (8, "http://empty.example/", "")]
    df = spark.createDataFrame([(*r, "taken") for r in rows], "page_id long, url string, html string, text string")
    got = {r["page_id"]: r["text"] for r in extraction.extract(df, ["page_id", "url"]).collect()}
    assert got[5] == "Brief." and got[0] == ("Article text that is long. " * 5).strip()
    assert (got[6], got[7], got[8]) == ("", "alone", "")
    assert extraction.extract(df, ["page_id"]).count() == 10
    assert extraction.extract(df.limit(0), ["page_id"]).count() == 0


def test_pages_that_the_winning_path_misses(spark):
    long = ("Text of the article, sentence by sentence. " * 9).strip()
    pages = [("http://a.example/", f'<div class="post"><p>{long}</p></div>')] * 4
    pages += [("http://a.example/", f'<div class="post"><img></div><div class="story"><p>{long} Other.</p></div>')]
    pages += [("http://a.example/", f'<div class="post"><p>A teaser.</p></div><article><p>{long} Third.</p></article>')]
    # Without a host, sites have nothing in common.
    pages += [(None, f"<div><p>{long}</p></div>")] * 3 + [("/relative", f"<div><p>Teaser.</p></div><section><p>{long} Fourth.</p></section>")]
    df = spark.createDataFrame([(k, u, PAGE.format(body=b)) for k, (u, b) in enumerate(pages)], "page_id long, url string, html string")
    got = [r["text"] for r in extraction.extract(df, ["page_id"]).orderBy("page_id").collect()]
    assert got == [long] * 4 + [f"{long} Other.", f"{long} Third."] + [long] * 3 + [f"{long} Fourth."]
    assert {r["host"] for r in extraction.votes(df).collect()} == {"a.example"}


def test_lanes_and_windows_of_the_automaton():
    """Any number of lanes gives the places that a plain search of all windows gives, short items and nested ones included."""
    random.seed(41)
    word = lambda: random.choice("abcd")
    items = [(str(k), " ".join(word() for _ in range(random.choice([1, 2, 3, 5, 9])))) for k in range(12)] + [("x", "a a a a a"), ("x", None), (None, "b b b b"), ("y", "a a")]
    automaton = decontamination.Automaton(items, window=4)
    texts = [" ".join(random.choice([word(), "unknown"]) if random.random() < 0.2 else word() for _ in range(random.randint(0, 60))) for _ in range(40)] + [None, "", "a"]
    windows = [(i, w[k:k + 4]) for i, t in items for w in [words_of(t)] for k in range(max(1, len(w) - 3) if w else 0)]
    for lanes in (1, 2, 7, 500):
        for text, (n, hits, spans, ids) in zip(texts, decontamination.scan_texts(automaton, texts, lanes)):
            words, marked, found = words_of(text), set(), set()
            for item, window in windows:
                for p in range(len(words) - len(window) + 1):
                    if words[p:p + len(window)] == window:
                        marked |= set(range(p, p + len(window)))
                        found |= {item} - {None}
            assert (n, {p for a, b in hits for p in range(a, b)}, ids) == (len(words), marked, sorted(found))
            assert all(b < c for (_, b), (c, _) in zip(hits, hits[1:]))
            assert [words_of(text[a:b]) for a, b in spans] == [words[a:b] for a, b in hits]
    assert decontamination.scan_texts(decontamination.Automaton([]), ["a b"]) == [(2, [], [], [])]


def test_five_megabytes_of_items_are_one_scan(spark):
    random.seed(43)
    words = [f"w{k:x}" for k in range(60_000)]
    items = [(k, " ".join(random.choices(words, k=450))) for k in range(1_900)]
    assert sum(len(t) for _, t in items) > 4_900_000
    docs = [(k, " ".join(random.choices(words, k=30))) for k in range(30)]
    docs += [(100 + k, f"{' '.join(random.choices(words, k=20))} {' '.join(items[k * 37][1].split()[100:100 + k])} end") for k in range(10, 20)]
    found = decontamination.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"), ["doc_id"])
    got = {r["doc_id"]: (r["n_hit"], r["item_ids"]) for r in found.withColumn("n_hit", decontamination.n_hit()).collect()}
    assert got == {k: (0, []) for k in range(30)} | {100 + k: (k, [str(k * 37)]) if k >= 13 else (0, []) for k in range(10, 20)}
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_run_together_names_of_other_parts():
    long = ("Text of the article, sentence by sentence. " * 9).strip()
    for names in ("discussion", "commentlist", "advertorial", "adsbygoogle", "header", "siteheader", "page-header", "reader-feedback", "topNav", "user_comments", "commentsection"):
        for tag in ("div", "ol" if "comment" in names else "div"):
            other = f'<{tag} class="{names}"><li>Other words here.</li></{tag}>' if tag == "ol" else f'<{tag} class="{names}"><p>Other words here.</p></{tag}>'
            inside = f"<article><p>{long}</p>{other}<p>After.</p></article>"
            assert extraction.Page(PAGE.format(body=inside)).text(None) == f"{long} After.", names
            assert extraction.Page(f"<html><body>{other}<p>{long}</p><p>After.</p></body></html>").text(None) == f"{long} After.", names
    for names in ("article-header", "entry-header", "post-footer", "commentary", "subheader", "content-header", "storyheader"):
        assert extraction.Page(PAGE.format(body=f'<article><div class="{names}"><p>Kept.</p></div><p>{long}</p></article>')).text(None) == f"Kept. {long}", names
    paper = f'<article><p>{long}</p><section class="discussion"><h2>Discussion</h2><p>Kept.</p></section></article>'
    assert extraction.Page(PAGE.format(body=paper)).text(None) == f"{long} Discussion Kept."


def test_hosts_of_several_templates(spark):
    long = ("Text of the article, sentence by sentence. " * 5).strip()
    news = [f'<div class="lead"><p>{long} {k}</p></div>' for k in range(5)]
    blog = [f'<div class="lead"><p>A teaser.</p></div><div class="entry"><p>{long} {long} {k}</p></div>' for k in range(4)]
    df = spark.createDataFrame([(k, "http://a.example/", PAGE.format(body=b)) for k, b in enumerate(news + blog)], "page_id long, url string, html string")
    got = [r["text"] for r in extraction.extract(df, ["page_id"]).orderBy("page_id").collect()]
    assert got == [f"{long} {k}" for k in range(5)] + [f"{long} {long} {k}" for k in range(4)]


def test_ties_of_votes(spark):
    """Two paths with as many votes: the first in alphabetical order wins, whatever the order of the rows."""
    long = ("Text of the article, sentence by sentence. " * 5).strip()
    one = f'<div class="a"><p>{long} one</p></div><div class="b"><p>Short.</p></div>'
    two = f'<div class="a"><p>Brief.</p></div><div class="b"><p>{long} two</p></div>'
    for order in ([one, two], [two, one]):
        df = spark.createDataFrame([(k, "http://a.example/", PAGE.format(body=b)) for k, b in enumerate(order)], "page_id long, url string, html string")
        got = {r["text"] for r in extraction.extract(df, ["page_id"]).collect()}
        assert got == {f"{long} one", "Brief."}


def generated_page(rng, host):
    """A page and its article, written apart from any reading of it: parts around and inside the article, by host's template."""
    sentence = lambda n: " ".join("".join(rng.choices("abcdeé", k=rng.randint(2, 8))) for _ in range(n)) + "."
    beside = ["<nav><a href=/>{}</a></nav>", '<div class="cookie-banner">{}</div>', '<div class="adsbygoogle">{}</div>', "<footer>{}</footer>", '<ul class="menu"><li>{}</ul>',
              '<div id="comments"><p>{}</p></div>', "<script>var x = '<p>{}</p>'</script>", "<aside><p>{}</p></aside>", '<div class="site-header">{}</div>', "<form><p>{}</p><input></form>",
              "<!-- {} -->", '<p class="notice">{}</p>', "<style>{}</style>", '<ol class="commentlist"><li>{}</ol>']
    other = lambda: rng.choice(beside).format(sentence(rng.randint(1, 6)))
    blocks, pieces = [], []
    for _ in range(rng.randint(4, 12)):
        text = sentence(rng.randint(12, 40))
        blocks.append(text)
        cut = text.split(" ")
        if rng.random() < 0.5:
            k = rng.randrange(len(cut))
            cut[k] = f"<b>{cut[k]}</b>"
        raw = rng.choice([" ", "\n  ", "\t"]).join(cut).replace("é", rng.choice(["é", "&eacute;", "&#233;"]))
        pieces.append(rng.choice(["<p>{}</p>", "<p>{}", "<h2>{}</h2>", "<blockquote>{}</blockquote>", "<ul><li>{}</li></ul>", "<pre>{}</pre>"]).format(raw))
        if rng.random() < 0.3:
            pieces.append(other())
    shells = ["<article>{}</article>", '<main class="m">{}</main>', '<div class="story-7">{}</div>', '<div id="x" class="page-text"><section>{}</section></div>']
    body = "".join(other() for _ in range(rng.randint(0, 4))) + shells[host % 4].format("".join(pieces)) + "".join(other() for _ in range(rng.randint(0, 4)))
    return f"<!DOCTYPE html><html><head><title>{sentence(3)}</title></head><body>{body}</body></html>", " ".join(blocks)


def test_generated_pages(spark):
    rng = random.Random(44)
    made = [(k, k % 8, *generated_page(rng, k % 8)) for k in range(240)]
    df = spark.createDataFrame([(k, f"https://h{h}.example/{k}", html) for k, h, html, _ in made], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in extraction.extract(df, ["page_id"]).collect()}
    wrong = [k for k, _, _, want in made if got[k] != want]
    assert not wrong, (len(wrong), made[wrong[0]][2], got[wrong[0]], made[wrong[0]][3])


def test_a_text_of_very_many_findings(spark):
    """100,000 findings of one text, in pieces: counts and places as a plain search gives them."""
    n = 100_000
    df = spark.createDataFrame([(1, "cc by x " * n), (2, "all rights reserved " * 700 + "cc by")], DOCS)
    got = {r["doc_id"]: r for r in licenses.scan(df, ["doc_id"]).collect()}
    assert [f["start"] for f in got[1]["base"]] == list(range(0, 3 * n, 3)) and {f["stop"] - f["start"] for f in got[1]["base"]} == {2}
    assert got[1]["n_words"] == 3 * n and len(got[1]["findings"]) >= n
    _, found, kept = brute_findings("all rights reserved " * 700 + "cc by")
    assert sorted((f["start"], f["stop"], f["priority"], f["rule"], f["label"]) for f in got[2]["findings"]) == kept
    assert len(got[2]["base"]) == 701


def test_pieces_of_findings_change_nothing(spark, monkeypatch):
    random.seed(45)
    pieces = ["MIT License", "cc by", "all rights reserved", "GPL-2.0 or later", "the GNU General Public License v3", "word", "Apache License Version 2.0"]
    texts = [" ".join(random.choices(pieces, k=random.randint(0, 30))) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    whole = [tuple(r) for r in licenses.scan(df, ["doc_id"]).orderBy("doc_id").collect()]
    for size in (1, 3):
        monkeypatch.setattr(licenses, "PIECE", size)
        assert [tuple(r) for r in licenses.scan(df, ["doc_id"]).orderBy("doc_id").collect()] == whole
