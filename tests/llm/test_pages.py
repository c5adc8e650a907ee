"""URL rules, archives and main text against brute force and known pages."""

import base64
import gzip
import hashlib
import html
import random
import re

import pytest

from tillwatch.llm import url_filter, warc, wrappers
from tillwatch.llm.html_tokens import block_items
from tillwatch.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PAGES = "page_id bigint, url string, html string, host string, key string"


# -- URL rules


def brute_judge(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.partition("://")[2], re.S).groups()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, 0, None, "allow"))
    return host, path, best[3], best[4]


def test_url_rules(spark):
    rng = random.Random(3)
    labels = ["com", "net", "a", "b", "ab", "example", "é", "x-y"]
    paths = ["", "/", "/en", "/en/", "/en/x", "/EN/", "/fr/1"]

    def host():
        return ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))

    rules = sorted({(host(), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(60)})
    urls = [None, "", "nothing", "http://", "://a.com/en/", "http://COM", "http://.com/en/", "http://a..com/",
            "ftp://u@a.com:8080/en/?q=/fr/", "x://a.com#://b.net/", "http://a.com\n/en/"]
    urls += [f"http://{host()}{rng.choice(paths)}{rng.choice(['', '?a', '#b', 'z'])}" for _ in range(500)]
    urls += ["http://hot.example.com/en/1"] * 300
    rows = [(i, u, "", "clash", "") for i, u in enumerate(urls)]
    df = spark.createDataFrame(rows, PAGES).repartition(4)
    table = spark.createDataFrame([*rules, (None, "/", "block")], "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(df, table).collect()}
    assert got == {i: brute_judge(u, rules) for i, u in enumerate(urls)}
    none = url_filter.judge_urls(df, table.limit(0), default="block").collect()
    assert len(none) == len(urls) and {(r.rule, r.verdict) for r in none} == {(None, "block")}
    assert url_filter.judge_urls(df.limit(0), table).count() == 0


# -- archives


def pages_of(payloads):
    return [(i, f"http://h/{i}?a b" if i % 7 else None, p, "clash", "") for i, p in enumerate(payloads)]


@pytest.mark.parametrize("split, roll", [(64 << 20, 1 << 30), (700, 4_000), (97, 1)])
def test_archives_round_trip(spark, tmp_path, split, roll):
    rng = random.Random(1)
    payloads = [None, "", "a", "é" * 500, "a", None, "x" * 30_000, "a"]
    payloads += ["".join(rng.choice("abcdefgh <>\r\n") for _ in range(rng.randint(0, 900))) for _ in range(60)]
    rows = pages_of(payloads) + [(2, "http://again", "a", "", ""), (None, "u", "a", "", ""), (None, None, "only", "", "")]
    df = spark.createDataFrame(rows, PAGES).repartition(3)
    where = str(tmp_path / "w")
    manifest = warc.write_archives(df, where, roll_bytes=roll)
    got = warc.read_archives(manifest, where, split_bytes=split).collect()
    assert len(got) == len(rows)
    last = {}
    for i, _, p, _, _ in rows:
        p = (p or "").encode()
        last[p] = max([x for x in (last.get(p), i) if x is not None], default=None)
    want = sorted(str((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(),
                       "revisit" if i != last[p] else "response", last[p] if i != last[p] else None,
                       p if i == last[p] else b""))
                  for i, _, p, _, _ in ((i, u, (p or "").encode(), h, k) for i, u, p, h, k in rows))
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload)))
                  for r in got) == want
    for name in {r.file for r in manifest.collect()}:  # plain gzip reads the same bytes
        assert gzip.open(f"{where}/{name}").read().count(b"WARC/1.1\r\n") >= 1


def test_headers_of_any_length_and_a_task_per_range(spark, tmp_path):
    """A url of over a million characters, records before and after it, ranges that start inside them."""
    rng = random.Random(1)
    url = "http://h/" + "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(1_500_000))
    rows = [(i, url if i == 2 else f"http://h/{i}", f"page {i} " * 500, "", "") for i in range(5)]
    manifest = warc.write_archives(spark.createDataFrame(rows, PAGES).coalesce(1), str(tmp_path))
    for split in (100_000, 1 << 26):
        read = warc.read_archives(manifest, str(tmp_path), split_bytes=split)
        assert sorted((r.page_id, r.url) for r in read.collect()) == [(r[0], r[1]) for r in rows]
        total = sum(r.bytes for r in manifest.collect())
        assert read.rdd.getNumPartitions() == -(-total // split)


def test_a_record_that_cannot_be_read_is_an_error(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"page {i} " * 500, "", "") for i in range(5)]
    manifest = warc.write_archives(spark.createDataFrame(rows, PAGES).coalesce(1), str(tmp_path))
    file = next(tmp_path.glob("*.warc.gz"))
    data = bytearray(file.read_bytes())
    third = [m.start() for m in re.finditer(b"\x1f\x8b\x08", data)][2]
    data[third + 30] ^= 0xFF
    file.write_bytes(data)
    with pytest.raises(Exception, match="no record can be read"):
        warc.read_archives(manifest, str(tmp_path)).count()


def test_small_payloads_are_all_responses(spark, tmp_path):
    df = spark.createDataFrame(pages_of(["aa", "aa", "bbbb", "bbbb"]), PAGES)
    got = warc.read_archives(warc.write_archives(df, str(tmp_path), min_bytes=3), str(tmp_path)).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in got) == [
        (0, "response", None), (1, "response", None), (2, "revisit", 3), (3, "response", None)]
    empty = warc.write_archives(df.limit(0), str(tmp_path / "none"))
    assert warc.read_archives(empty, str(tmp_path / "none")).count() == 0


class Bytes:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at:at + n]


def test_magic_inside_payloads_is_no_record():
    inner = warc.member(9, "http://inner", b"inside", None, "2000-01-01T00:00:00Z")
    noise = random.Random(2).randbytes(5_000)
    parts = [b"x", warc.MAGIC + b"\x00" * 20, inner, noise + inner + noise, inner + inner, b"end"]
    data = b"".join(warc.member(i, None, p, None, "2000-01-01T00:00:00Z") for i, p in enumerate(parts))
    for width in (61, 1_000, len(data)):
        found = [h["x-page-id"] for s in range(0, len(data), width)
                 for h, _ in warc.records_in(Bytes(data), len(data), s, s + width)]
        assert found == ["0", "1", "2", "3", "4", "5"]


# -- main text


def test_main_text_of_generated_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op10_main_text"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        plain = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", " ", inner))
        assert r.text == " ".join(html.unescape(plain).split())
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


SHELL = ("<html><head><title>t</title><style>p{{}}</style></head><body class='no-sidebar'><div id=cookie-notice>OK?</div>"
         "<header><h2>Site</h2></header><nav><ul><li><a href=/>Home</a><li>Two</ul></nav>"
         "<div class='page with-sidebar'><main>{0}</main><aside>More</aside></div>"
         "<section class=comments><article>first!</article></section><form>mail <input></form>"
         "<footer>&copy; us</footer><script>if (a<b) '</p>'</script></body>")


def test_main_text_cases(spark):
    bodies = {
        "a": ("<h1>T &amp; U</h1><p>one <b>b</b>old<p>two<br>lines <!-- no --> end<div class='ad-box ad'>buy</div>"
              "<ul><li>x<li>y</ul><div class=share>tweet</div>", "T & U one bold two lines end x y"),
        "b": ("<h1>Solo</h1>", "Solo"),
        "c": ("<p>a&nbsp;b&#x41;&lt;p&gt; 1 < 2 &copy; </p><table><tr><td>c1<td>c2</table><pre> k\n  v</pre>",
              "a bA<p> 1 < 2 © c1 c2 k v"),
        "d": ("<p>" + "long " * 20_000, ("long " * 20_000).strip()),
        "e": ("<form>q</form><script>x</script><p hidden>h</p>", ""),
        "f": ("<p title='a > b'>attr<p><a href=x>linked</a> words<p>unclosed <b", "attr linked words unclosed"),
    }
    rows = [(i, f"http://h{i % 2}/{k}", SHELL.format(b), "", "") for i, (k, (b, _)) in enumerate(bodies.items())]
    rows += [(100, "http://h0/", None, "", ""), (101, None, "", "", ""), (102, "http://h9", "just words", "", ""),
             (0, "http://h0/a", SHELL.format(bodies["a"][0]), "", "")]
    df = spark.createDataFrame(rows, PAGES).repartition(3)
    got = sorted((r.page_id, r.text, r.n_chars) for r in wrappers.main_text(df).collect())
    want = [(i, t) for i, (_, t) in enumerate(bodies.values())] + [(100, ""), (101, ""), (102, "just words"), (0, bodies["a"][1])]
    assert got == sorted((i, t, len(t)) for i, t in want)
    assert wrappers.main_text(df.limit(0)).count() == 0


def test_wrapper_finds_furniture_without_a_main_element(spark):
    page = "<body><div>Daily News</div><ul>{1}</ul><div><p>{0} one<p>{0} two</div><div>Imprint and contact</div>"
    rows = [(i, "http://news/x", page.format(f"story {i}", "".join(
        f"<li><a href={k}>Link {k}</a>" for k in range(2 + i % 3))), "", "") for i in range(8)]
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: f"story {i} one story {i} two" for i in range(8)}


def test_alignment_makes_optional_and_repeated_groups():
    def keys(page):
        return wrappers.expression(block_items(page))

    one = keys("<body><div><h1>a</h1><p>x<p>y</div>")
    two = keys("<body><div><p>x</div><table><tr><td>1</table>")
    for n in (*one, *two):
        for leaf in n.leaves():
            leaf.pages = 1
    merged = wrappers.align(one, two)
    assert [n.optional for n in merged if "h1" in n.key] == [True, True]
    assert [n.key for n in merged if n.body] == ["(B|p|,#B|p|)+"]
    assert all(n.optional for n in merged if "td" in n.key or "table" in n.key)


@pytest.mark.parametrize("copies", [2, 3, 5])
def test_copies_of_a_page_are_one_page(spark, copies):
    page = "<body><div>Daily News</div><ul><li><a href=/>Home {0}</a></ul><div><p>{0} one<p>{0} two</div><div>Imprint</div>"
    alone = "<body><div>Daily News</div><ul><li><a href=/>Copy {0}</a></ul><h1>Only here</h1><h2>A lead</h2><pre>and a body</pre>"
    rows = [(i, "http://news/x", page.format(f"story {i}"), "", "") for i in range(6)]
    rows += [(100 + i, "http://news/y", alone.format(i), "", "") for i in range(copies)]
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, PAGES).repartition(3)).collect()}
    assert got == {i: f"story {i} one story {i} two" for i in range(6)} | {
        100 + i: "Only here A lead and a body" for i in range(copies)}


def test_wrapper_finds_furniture_inside_the_main_element(spark):
    page = "<body><article><h1>Title {0}</h1><p>{0} one<p>{0} two<div>Read our letter</div>{1}</article>"
    some = "<section>Story of the series</section>"  # on a third of the pages: content
    rows = [(i, "http://news/x", page.format(f"story {i}", some if i % 3 == 0 else ""), "", "") for i in range(9)]
    rows += [(20, "http://few/x", page.format("a", ""), "", ""), (21, "http://few/y", page.format("b", ""), "", "")]
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, PAGES).repartition(3)).collect()}
    want = {i: f"Title story {i} story {i} one story {i} two" + (" Story of the series" if i % 3 == 0 else "") for i in range(9)}
    assert got == want | {i: f"Title {x} {x} one {x} two Read our letter" for i, x in ((20, "a"), (21, "b"))}


def test_recurring_headings_go_with_what_they_head(spark):
    """A heading on every page stays before text of the page, and goes before text of the host."""
    page = ("<body><article><h1>Title {0}</h1><h2>Summary</h2><p>{0} one<h2>Conclusion</h2><h3>In short</h3><p>{0} two"
            "<dl><dt>Price<dd>{0} coins</dl><h2>Our letter</h2><p>Write to us</article>")
    rows = [(i, "http://news/x", page.format(f"story {i}"), "", "") for i in range(6)]
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, PAGES).repartition(3)).collect()}
    assert got == {i: f"Title story {i} Summary story {i} one Conclusion In short story {i} two Price story {i} coins" for i in range(6)}


def test_one_word_of_a_name_drops_no_content(spark):
    cases = {
        "a": ("<article><h2 id='related-work'>Related work</h2><section id='search-methods'><p class='social'>Body</p></section>"
              "<div id='menu-design'>Design</div></article>", "Related work Body Design"),
        "b": ("<article class='has-comments'><h1>T</h1><p>text</article>", "T text"),
        "c": ("<main id='ad-free'><p>free</main><div class=comments><article>first!</article></div>", "free"),
        "d": ("<div class='layout with-sidebar'><h1>Head</h1><p>all the body</div>", "Head all the body"),
        "e": ("<article class='comment'><p>only this</article>", "only this"),
        "f": ("<div class='sidebar'><p>nothing else</div>", "nothing else"),
        "g": ("<article><p>kept</p><div class='share'>tweet</div><article class='comment'>me too</article></article>", "kept"),
    }
    rows = [(i, f"http://h{i}/", f"<html><body>{page}</body></html>", "", "") for i, (page, _) in enumerate(cases.values())]
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: text for i, (_, text) in enumerate(cases.values())}
