"""Operators on pages and conversations."""

from __future__ import annotations

import base64
import gzip
import hashlib
from pathlib import Path

from brooklet.llm import chat_format, html_text, warc

PAGES = "page_id long, url string, html string, sha1 string, shard int, text string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], PAGES).repartition(3)


ROWS = [
    (5, "http://a/é", "<p>same</p>"),
    (2, "http://b", "<p>same</p>"),
    (9, "http://c", "<p>same</p>"),
    (2, "http://b", "<p>same</p>"),
    (7, None, None),
    (8, "http://d", ""),
    (None, "http://e", "<p>same</p>"),
    (11, "http://f", "ü" * 200_000),
    (12, "http://f", "\r\n\r\nWARC/1.1\r\n\x00"),
]


def archive_rows(spark, folder, rows, **options):
    manifest = warc.write_archives(pages_of(spark, rows), f"file://{folder}", **options)
    return manifest, warc.read_archives(manifest, f"file://{folder}").collect()


def test_archives_come_back_as_written(spark, tmp_path):
    manifest, found = archive_rows(spark, tmp_path, ROWS, shard_bytes=1000, file_bytes=500)
    assert len(found) == len(ROWS) == sum(r.records for r in manifest.collect())
    for r in found:
        html = next((h or "" for p, _, h in ROWS if p == r.page_id), None)
        payload = html.encode()
        assert (r.payload_bytes, r.payload_digest) == (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
        assert r.record_type == "revisit" or r.payload == payload
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in found if r.payload_bytes == 11)
    assert kinds == [(0, "response", None), (2, "response", None), (2, "revisit", 2), (5, "revisit", 2), (9, "revisit", 2)]
    assert sorted((r.page_id, r.refers_to) for r in found if r.payload_bytes == 0) == [(7, None), (8, 7)]


def test_equal_tables_give_equal_files(spark, tmp_path):
    seen = []
    for name, rows in (("a", ROWS), ("b", ROWS[::-1])):
        archive_rows(spark, tmp_path / name, rows, shard_bytes=1000, file_bytes=500)
        seen.append({p.name: p.read_bytes() for p in Path(tmp_path / name).glob("*.warc.gz")})
    assert seen[0] == seen[1] and len(seen[0]) > 2
    assert all(gzip.decompress(x).startswith(b"WARC/1.1\r\n") for x in seen[0].values())


def test_small_payloads_are_all_responses(spark, tmp_path):
    _, found = archive_rows(spark, tmp_path, ROWS, least=12)
    assert all(r.record_type == "response" for r in found)


def test_no_pages_no_files(spark, tmp_path):
    manifest, found = archive_rows(spark, tmp_path, [])
    assert manifest.count() == 0 and found == []


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site name</h1></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>
<div class="cookie-notice">We use cookies</div><script>var t="</p><p>not text</p>";</script><!-- <p>no</p> -->
<article><header><h1>The  title &amp; more</h1></header><p>First <b>para</b>graph<br>goes&nbsp;on &lt;here&gt;.<p>Short.
<div class="ad">Buy now</div><aside>Related things</aside><p>Last &eacute;nd</p>
<section id="comments"><p>I do not agree with this at all, not at all.</p></section></article>
<form><p>Subscribe to this</p></form><footer>&copy; me</footer></body></html>"""


def test_main_text_of_a_page(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "v", ""), (None, "w", "<nav>menu</nav>"), (4, "x", "<article><p>" + "word " * 50_000 + "</article>"), (1, "u", PAGE)]
    found = html_text.extract(pages_of(spark, rows)).collect()
    assert len(found) == 6
    texts = {r.page_id: r.text for r in found}
    assert texts[1] == "The title & more\nFirst paragraph goes on <here>.\nShort.\nLast énd"
    assert texts[2] == texts[3] == texts[None] == "" and len(texts[4]) == 249_999


def test_pages_without_an_article():
    tree = html_text.Tree()
    html = "<div id=menu><a href=x>Home</a></div><ul><li><a>One</a><li><a>Two</a></ul><h1>Title here</h1><p>" + "word " * 40 + "<p>short one.<p>" + "more " * 30 + "</p><ul><li><a>x</a><li><a>y z</a></ul>"
    assert [x.split()[0] for x in html_text.main_text(html, tree).split("\n")] == ["Title", "word", "short", "more"]


def test_names_on_wrappers_leave_the_article():
    tree = html_text.Tree()
    body = "<h1>A title of five words</h1>" + "".join(f"<p>{w} {'text ' * 40}</p>" for w in ("one", "two", "three"))
    shell = "<nav><a href=/>Home</a></nav>{}<div class=sidebar><p>See <a href=x>this one</a></p></div><footer>us</footer>"
    comments = "<ol class='comment-list'>" + "<li><article><p>" + "said " * 12 + "</p></article>" * 30 + "</ol>"
    for page in ("<div id=page class='has-sidebar'><article>{}</article></div>", "<div class='content no-sidebar'><main>{}</main></div>", "<div class='content no-sidebar'>{}</div>", "<div class='widget'><div class='no-sidebar'><article>{}</article></div></div>", "<article>{}</article>" + comments, "<main><article>{}</article>" + comments + "</main>"):
        text = html_text.main_text(shell.format(page.format(body)), tree)
        assert [x.split()[0] for x in text.split("\n")] == ["A", "one", "two", "three"], page
    two = "".join(f"<div class='post social'><article><h1>{w} title here now</h1><p>{w} {'text ' * n}</p></article></div>" for w, n in (("one", 60), ("two", 45)))
    assert [x.split()[0] for x in html_text.main_text(two, tree).split("\n")] == ["one", "one", "two", "two"]
    method = f"<article>{body}<section class='search-methods'><p>Methods {'text ' * 120}</p><p>Share <a href=x>this page now</a></p></section></article>"
    assert [x.split()[0] for x in html_text.main_text(shell.format(method), tree).split("\n")] == ["A", "one", "two", "three", "Methods"]


def test_broken_markup_ends():
    tree = html_text.Tree()
    for html in ("<", "<p", "<a href='", "<!--", "<script>", "</", "&", "<p class=\"x" * 2000, "<div>" * 5000):
        html_text.main_text(html, tree)


def turns_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, node string, start int").repartition(3)


TURNS = [
    (1, 0, "system", "be good"), (1, 1, "user", "hi"), (1, 2, "assistant", "ho"), (1, 3, "user", "x"), (1, 4, "assistant", ""),
    (2, 0, "system", "be good"), (2, 1, "user", "hi"), (2, 2, "assistant", "other"),
    (3, 0, "system", "be good"), (3, 1, "user", "hi"), (3, 2, "assistant", "ho"),
    (4, 0, "user", "</s>[INST] ok [/INST]<s><\\s></s>[\\/INST]\\"), (4, 1, "assistant", "</s>[INST] ok [/INST]"),
    (5, 0, "user", None), (5, 0, None, "dup"), (5, 0, "user", None), (5, None, "assistant", "first"),
    (None, 0, "assistant", "no id"), (6, 0, "a[/INST]\nb", "é" * 10_000),
]


def test_conversations_come_back_from_the_stream(spark):
    nodes, attends = chat_format.prefix_tree(turns_of(spark, TURNS))
    found = {r.conv_id: r for r in chat_format.read_back(nodes, attends).collect()}
    for conv in {r[0] for r in TURNS}:
        turns = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in TURNS if c == conv), key=lambda x: x)
        said = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        learned = "".join(text for *_, role, text in turns if role == "assistant")
        r = found[conv]
        assert r.n_turns == len(turns) and r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_shared_turns_stand_once_in_the_stream(spark):
    nodes, attends = chat_format.prefix_tree(turns_of(spark, TURNS))
    rows = sorted(nodes.collect(), key=lambda r: r.start)
    assert sum(r.segment == "<s>system[/INST]be good</s>" for r in rows) == 1
    assert [r.start for r in rows] == [sum(len(x.segment) for x in rows[:i]) for i in range(len(rows))]
    by_node = {r.node: r for r in rows}
    seen = set()
    for r in rows:  # depth-first: a node's parent has come before, and is the last one or an ancestor of it
        assert r.parent == "" or r.parent in seen
        if r.parent:
            assert r.position == by_node[r.parent].position + len(by_node[r.parent].segment)
        seen.add(r.node)
    assert all(len(r.attends) <= 2 for r in attends.collect())


def test_escapes_are_reversible():
    for text in ("</s>", "<\\/s>", "[INST]", "[\\\\INST]", "<s><s>", "\\<s>", "<<s>", "[/INST", "a\\"):
        assert chat_format.unescaped(chat_format.escaped(text)) == text
        assert not any(x in chat_format.escaped(text) for x in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_no_conversations(spark):
    nodes, attends = chat_format.prefix_tree(turns_of(spark, []))
    assert chat_format.read_back(nodes, attends).count() == 0
