"""Merkle trees, the URL index and HTML extraction against plain Python."""

from __future__ import annotations

import random
from hashlib import sha256
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from metagauge.llm import html_blocks, merkle, queries, urlfilter
from metagauge.llm.html_pages import labelled_pages


def hexed(s: str) -> str:
    return sha256(s.encode()).hexdigest()


def model_tree(text):
    if text is None:
        return None
    sections, own = [], []
    for line in text.split("\n"):
        line = line.strip(" \t\r\x0b\f")
        if line.startswith("#") or line == "":
            sections.append(own)
            own = []
        if line:
            own.append(line)
    sections = [s for s in [*sections, own] if s]
    leaves = [[hexed("p" + p) for p in s] for s in sections]
    tops = [hexed("s" + "".join(s)) for s in leaves]
    return hexed("d" + "".join(tops)), tops, leaves


TEXTS = [None, "", " \n ", "a", "a\nb", "a\n\nb", "# t\na\n# u\nb", "a\r\n\r\nb", "#\n#", "é\n\n\n\n x ", "a\n \nb\n", "x\n#y\nz"]


def test_trees_equal_model(spark, docs):
    rows = list(enumerate(TEXTS)) + [(1000 + r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r for r in merkle.tree(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        want = model_tree(t)
        assert (got[i].root, got[i].sections, got[i].leaves) == (want or (None, None, None))


def test_roots_test_equality(spark, awkward):
    out = merkle.fingerprints(awkward).collect()
    assert len(out) == awkward.count()
    texts = {r.doc_id: r.text for r in awkward.collect()}
    assert {r.equal_to for r in out if r.doc_id in (7, 8)} == {7}
    assert all((r.root is None) == (texts[r.doc_id] is None) for r in out if r.doc_id is not None and r.doc_id != 9)
    assert merkle.fingerprints(awkward.limit(0)).count() == 0


def test_differences_locate_edits(spark):
    old = [(1, "a\nb\n\nc\nd\n\ne"), (2, "same"), (3, "gone"), (5, None), (6, "s\n\nt"), (7, None)]
    new = [(1, "a\nb\n\nc\nX\n\ne"), (2, "same  \n\n"), (4, "come"), (5, "x"), (6, "s\n\nr\n\nt"), (7, None)]
    a, b = (merkle.tree(spark.createDataFrame(r, "doc_id long, text string")) for r in (old, new))
    got = sorted(tuple(r) for r in merkle.differences(a, b).collect() if r.section is not None)
    assert got == [(1, "edited", 1, 1), (5, "edited", 0, 0), (6, "edited", 1, 0)]
    assert sorted((r.doc_id, r.change) for r in merkle.differences(a, b).where("section is null").collect()) == [(3, "removed"), (4, "added")]


def test_equal_paragraphs_between_edits_are_left_out(spark):
    a, b = (merkle.tree(spark.createDataFrame([(1, t)], "doc_id long, text string")) for t in ("a\nb\nc\n\nd\n\ne", "x\nb\nz\n\nd\n\ny"))
    assert sorted(tuple(r) for r in merkle.differences(a, b).collect()) == [(1, "edited", 0, 0), (1, "edited", 0, 2), (1, "edited", 2, 0)]


@pytest.mark.parametrize("seed", range(3))
def test_random_edits_are_found(spark, seed):
    rng = random.Random(seed)
    olds, news, places = [], [], []
    for d in range(30):
        text = [[f"p{rng.randrange(10**9)}" for _ in range(rng.randrange(1, 5))] for _ in range(rng.randrange(1, 6))]
        olds.append((d, "\n\n".join("\n".join(s) for s in text)))
        i = rng.randrange(len(text))
        j = rng.randrange(len(text[i]))
        text[i][j] = "edited"
        news.append((d, "\n\n".join("\n".join(s) for s in text)))
        places.append((d, "edited", i, j))
    a, b = (merkle.tree(spark.createDataFrame(r, "doc_id long, text string")) for r in (olds, news))
    assert sorted(tuple(r) for r in merkle.differences(a, b).collect()) == places


ENTRIES = ["bad.example.com", "Worse.Example.org.", "ok.example.com/ads", "ok.example.com/Ads/x/", None, " ", "bad.example.com", "a.b"]
URLS = {
    "http://bad.example.com/": "bad.example.com", "https://www.BAD.example.com:8080/x?y#z": "bad.example.com", "http://user:pw@bad.example.com": "bad.example.com", "http://notbad.example.com/": None,
    "bad.example.com.": "bad.example.com", "//worse.example.org/x": "worse.example.org", "http://ok.example.com/ads": "ok.example.com/ads", "http://ok.example.com/ads/1?q": "ok.example.com/ads",
    "http://ok.example.com/adsx": None, "http://ok.example.com/Ads/x/y": "ok.example.com/Ads/x", "http://ok.example.com/Ads": None, "http://ok.example.com/?u=http://bad.example.com": None, "": None, None: None,
    "/path/only": None, "http:///x": None, "http://x.a.b/": "a.b", "http://bad.example.com.evil.com/": None, "  http://bad.example.com": "bad.example.com",
}


def test_urls(spark):
    index = urlfilter.build(spark, ENTRIES)
    df = spark.createDataFrame([(u, "x") for u in URLS], "url string, entry string")
    out = urlfilter.blocked(df, index)
    assert out.columns == ["url", "blocked", "entry"]
    got = {r.url: (r.blocked, r.entry) for r in out.collect()}
    assert got == {u: (e is not None, e) for u, e in URLS.items()}
    assert urlfilter.blocked(df.limit(0), index).count() == 0
    assert not urlfilter.blocked(df, urlfilter.build(spark, [])).where("blocked").count()


def test_ports_without_scheme(spark):
    index = urlfilter.build(spark, ["bad.example.com:8080", "ok.example.com:80/ads"])
    urls = ["bad.example.com:8080/x", "a.bad.example.com:1", "bad.example.com:80?q", "bad.example.com:80#f", "ok.example.com:81/ads/1", "user:80@bad.example.com", "http:bad.example.com", "ok.example.com:81/x", "bad.example.com.evil.com:80/"]
    got = {r.url: r.entry for r in urlfilter.blocked(spark.createDataFrame([(u,) for u in urls], "url string"), index).collect()}
    assert [got[u] for u in urls] == ["bad.example.com"] * 4 + ["ok.example.com/ads"] + ["bad.example.com"] * 2 + [None] * 2


def test_one_label_equals_sql(spark, duck):
    entries = ["zip", "localhost", "bad.example.com"]
    urls = ["http://a.zip/x", "https://a.b.ZIP.:80", "http://zip", "http://azip/", "http://zip.org/", "http://localhost:8080/x", "http://x.localhost", "http://www.bad.example.com", "http://com/", "http://a..zip", "http://", ""]
    index = urlfilter.build(spark, entries)
    got = {r.url: (r.blocked, r.entry) for r in urlfilter.blocked(spark.createDataFrame([(u,) for u in urls], "url string"), index).collect()}
    sql = queries._URL_SQL.replace(queries._ENTRIES, ", ".join(f"('{e}')" for e in entries)).replace("from pages", "from (select 0 as page_id, unnest(?) as url)")
    assert got == {url: (blocked, entry) for _, url, blocked, entry in duck.execute(sql, [urls]).fetchall()}
    assert sum(b for b, _ in got.values()) == 7


@pytest.mark.parametrize("shards", [1, 7])
def test_large_list_equals_a_set(spark, shards):
    """Also with an index of several shards; rows that repeat and very long URLs."""
    rng = random.Random(2)
    hosts = [f"h{rng.randrange(40_000)}.example.com" for _ in range(20_000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(shards == 1).lower())
    try:
        index = urlfilter.build(spark, spark.createDataFrame([(h,) for h in hosts], "h string"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(index) >= shards
    urls = spark.range(40_000).select(F.concat(F.lit("http://h"), "id", F.lit(".example.com/x"), F.when(F.col("id") % 1000 == 0, F.repeat(F.lit("/long"), 4000)).otherwise("")).alias("url"), "id")
    got = [r.id for r in urlfilter.blocked(urls.union(urls.where("id < 50")), index).where("blocked").collect()]
    want = {int(h[1:].split(".")[0]) for h in hosts}
    assert sorted(got) == sorted([*want, *(i for i in want if i < 50)])


def test_working_names_pass_through(spark):
    df = spark.createDataFrame([("http://bad.example.com", 5, 6, 7)], "url string, _uf_all int, _uf_keys int, _uf_at int")
    assert [tuple(r) for r in urlfilter.blocked(df, urlfilter.build(spark, ["bad.example.com"])).collect()] == [("http://bad.example.com", 5, 6, 7, True, "bad.example.com")]


def test_collisions_do_not_block(tmp_path):
    """Entries of equal digests: only the stored string itself counts."""
    texts = [b"one", b"two", b"three"]
    ends = np.cumsum([len(t) for t in texts])
    (tmp_path / "i").write_bytes(urlfilter._MAGIC + np.array([3, 7, 7, 9, *ends], "<i8").tobytes() + b"".join(texts))
    index = urlfilter.Index(str(tmp_path / "i"))
    asked = [(7, b"one"), (7, b"two"), (7, b"other"), (9, b"three"), (9, b"two"), (8, b"one"), (99, b"one")]
    got = index.probe(np.array([k for k, _ in asked]), lambda i: asked[i][1])
    assert got.tolist() == [0, 1, 3]


def naive(tree, row):
    while len(tree) > 1:
        f, cut, low, high = tree
        tree = low if row[f] <= cut else high
    return tree[0] >= 0.5


def test_tree_is_what_it_says():
    x, y = html_blocks.labelled_table()
    tree = html_blocks.grow(x, y)
    assert html_blocks.predict(tree, x).astype(bool).tolist() == [naive(tree, r) for r in x]
    assert (html_blocks.predict(tree, x) == y).mean() > 0.9


def test_tree_on_held_out_pages():
    pages = labelled_pages()
    right = total = 0
    for i, page in enumerate(pages):
        tree = html_blocks.grow(*html_blocks.labelled_table(pages[:i] + pages[i + 1 :]))
        x, y = html_blocks.labelled_table([page])
        right += (html_blocks.predict(tree, x) == y).sum()
        total += len(y)
    assert right / total > 0.85


def main_text(spark, *pages: str) -> list[str]:
    rows = html_blocks.extract(spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")).collect()
    return [r.text for r in sorted(rows)]


def test_text_without_links_around_an_article(spark):
    """Short lines without links on either side of an article go, headings stay, also right after navigation."""
    body = " ".join(["word"] * 59) + " end."
    got = main_text(
        spark,
        f"<div>Accept cookies</div><div>Subscribe now</div><p>{body}</p><div>Copyright 2024</div><div>All rights reserved</div>",
        f"<p>Accept cookies</p><p>{body}</p><p>Subscribe now</p><p>{body}</p><p>All rights reserved</p>",
        f"<nav><a href=/>Home</a> <a href=/x>More</a></nav><h1>A title</h1><p>{body}</p>",
        f"<head><title>t</title><body><div>Advertisement</div><h2>Part one</h2><p>{body}<h2>Part two</h2><p>{body}<footer>Contact us</footer>",
        f"<p>{body}</p><div>Share</div><ul><li><a href=1>One more</a><li><a href=2>And another</a></ul>",
        f"<button>Menu<p>{body}</p><select><option>a<option>b</select>",
    )
    assert got == [body, f"{body}\n{body}", f"A title\n{body}", f"Part one\n{body}\nPart two\n{body}", body, body]


class Plain(HTMLParser):
    """Blocks of pages without missing end tags, by the standard library's parser."""

    SKIP = frozenset("title script style textarea noscript template svg select button".split())

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.out, self.text, self.linked, self.depth, self.link = [], "", 0, 0, False
        self.feed(page)
        self.close()
        self.cut()

    def cut(self):
        if w := self.text.split():
            self.out.append((" ".join(w), len(w), self.linked))
        self.text, self.linked, self.link = "", 0, False

    def handle_starttag(self, tag, attrs):
        if tag in self.SKIP:
            self.depth += 1
        elif not self.depth and tag == "a":
            self.link = True
        elif not self.depth and tag == "br":
            self.text += " "
        elif not self.depth and tag not in html_blocks._INLINE:
            self.cut()

    def handle_endtag(self, tag):
        if tag in self.SKIP:
            self.depth -= 1
            self.text += " " * (not self.depth)
        elif not self.depth and tag == "a":
            self.link = False
        elif not self.depth and tag != "br" and tag not in html_blocks._INLINE:
            self.cut()

    def handle_data(self, data):
        if not self.depth:
            self.text += data
            self.linked += len(data.split()) * self.link


def random_page(rng: random.Random) -> str:
    def inner(depth: int) -> str:
        parts = []
        for _ in range(rng.randrange(1, 5)):
            kind = rng.choice(["text", "block", "inline", "skip", "br", "comment"])
            word = lambda: rng.choice(["one ", "two", " three ", "&amp; ", "&eacute;t ", "\n", "4 < 5 "])
            if kind == "text" or depth > 4:
                parts.append("".join(word() for _ in range(rng.randrange(4))))
            elif kind == "br":
                parts.append(" <br/> ")
            elif kind == "comment":
                parts.append(" <!-- <p>no</p> --> ")
            else:
                tag = rng.choice({"block": ["p", "div", "li", "h1", "td", "section"], "inline": ["b", "em", "span", "code"], "skip": ["script", "style", "svg", "button"]}[kind])
                parts.append(f' <{tag} class="x">{"no" if kind == "skip" else inner(depth + 1)}</{tag}> ')
        return "".join(parts)

    links = lambda: " ".join(f'<a href="/{i}">w{i} x</a>' for i in range(rng.randrange(3)))
    return f"<!DOCTYPE html><html><head><title>no</title></head><body>{inner(0)}<p>{links()} tail</p>{inner(0)}</body></html>"


def test_blocks_equal_those_of_another_parser(spark, sf):
    rng = random.Random(4)
    pages = [r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()] + [random_page(rng) for _ in range(1500)] + labelled_pages()
    for page in pages:
        assert html_blocks.blocks(page) == Plain(page).out, page


def test_blocks_and_link_words():
    page = "<head><title>no</title></head><body><script>var a = '<p>';</script><!-- <p>no</p> --><ul><li><a href=x>One</a><li><a>Two</a> three</ul><p>a &amp; <b>b</b>c<br>d</p>tail"
    assert html_blocks.blocks(page) == [("One", 1, 1), ("Two three", 2, 1), ("a & bc d", 4, 0), ("tail", 1, 0)]


@pytest.mark.parametrize(
    "before",
    [
        "<html><head><title>t</title><body>", "<head><title>t<meta charset=x><link rel=y><body>", "<head><script>x</script><title>t</title>", "<head><title>a <b>bold</b> t</title></head>", "<header></header>",
        "<svg width=1 />", "<svg/>", "<svg><path d=x>", "<svg><svg/><svg><text>no</text></svg><text>no</text></svg>", "<p><button>no", "<button>no <b>no</b><div>", "<button>no<p>no</p></button>", "<select><option>no<option>no",
        "<select><option>no</select>", "<noscript>", "<noscript><p>no</p></noscript>", "<template>", "<template><template></template><p>no</p></template>", "<!--> ", "<!-- <p>no -->", "<style>no</style >", "<textarea><p>no</textarea>",
    ],
)
@pytest.mark.parametrize("after", ["", "<button>no</button>", "<svg><text>no</text></svg>", "<noscript>no</noscript>", "<select><option>no</select>", "<script>no", "<style>no", "<textarea>no", "<!-- no"])
def test_missing_end_tags_lose_no_text(before, after):
    assert html_blocks.blocks(f"{before}<p>one two three</p>{after}") == [("one two three", 3, 0)]


def test_many_open_tags_take_no_square_time():
    for tag in ("<svg>", "<button>", "<select>", "<noscript>", "<template>", "<title>", "<head>", "<!-->"):
        assert html_blocks.blocks(tag * 50_000 + "<p>one two three</p>") == [("one two three", 3, 0)]


def test_extract_awkward(spark):
    body = " ".join(["words"] * 60)
    rows = [(1, None), (2, ""), (3, "<p></p>"), (4, f"<nav><a>home</a> <a>more</a></nav><p>{body}</p>"), (4, f"<p>{body}</p>"), (None, "<p"), (6, "<" * 1000), (7, "<p>" + "long " * 200_000), (8, "&#0; &bogus; <a><p>x")]
    df = spark.createDataFrame([(i, h, "t", 1) for i, h in rows], "page_id long, html string, text string, n_main int")
    got = html_blocks.extract(df).collect()
    assert len(got) == len(rows)
    one = {r.page_id: r for r in got if r.page_id != 4}
    assert (one[1].text, one[1].n_blocks) == (None, 0) and (one[2].text, one[3].text) == ("", "")
    assert [r.text for r in got if r.page_id == 4] == [body] * 2
    assert len(one[7].text) == 5 * 200_000 - 1
    with pytest.raises(ValueError, match="ids are integers"):
        html_blocks.extract(df.withColumn("page_id", F.lit("a17")))
    assert html_blocks.extract(df.limit(0)).count() == 0


def test_pages_keep_paragraphs_and_drop_links(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = html_blocks.extract(pages).join(pages.select("page_id", "html"), "page_id").collect()
    kept = lost = 0
    for r in rows:
        own = [b for b in html_blocks.blocks(r.html) if b[1] >= 25 and b[2] == 0]
        lines = set(r.text.split("\n"))
        kept += sum(b[0] in lines for b in own)
        lost += sum(b[0] not in lines for b in own)
        assert not [b for b in html_blocks.blocks(r.html) if b[1] == b[2] and b[0] in lines and b[1] > 1]
    assert kept > 10 * lost
