"""Spans, redaction, tokens, links and files, on small inline tables."""

from __future__ import annotations

import re
import threading
import time
from datetime import datetime
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from metagauge.operators import links, mapping, pii, relational, text, transform
from metagauge.sources import files
from metagauge.streaming import streams

TEXTS = [
    "call 9783025207 or 9876543210", "é9783025207", "card 8619-3997-5478-1234", "1234 5678 9012", "1234 5678 9012", "\U0001f600 ABCDE1234F, ABCDE1234F", "फोन 9783025207 पर",
    "", "abc", "ABCDE1234FG", "x9783025207", "5783025207", "123456789012 9783025207",
]


def python_spans(t):
    return sorted((m.start(), m.end(), r.entity, m[0]) for r in pii.DEFAULT for m in re.finditer(r.pattern, t))


def test_spans_equal_finditer(spark):
    df = spark.createDataFrame([(t,) for t in [*TEXTS, None]], "text string")
    got = sorted((r.text, r.start, r.end, r.entity, r.matched_text) for r in pii.analyze(df).collect())
    assert got == sorted((t, *s) for t in TEXTS for s in python_spans(t))


def test_no_entities_is_an_empty_table(spark):
    found = pii.analyze(spark.createDataFrame([("nothing",)], "text string"))
    assert found.count() == 0 and pii.entity_counts(found).columns == ["entity", "count"]


def test_redaction(spark):
    df = spark.createDataFrame([("a 9783025207 b ABCDE1234F",), ("none",), (None,)], "text string")
    assert [r.anonymized for r in pii.anonymize(df).collect()] == ["a <INDIAN_PHONE_NUMBER> b <PAN_CARD>", "none", None]


def test_model_recognizer_and_filter(spark):
    own = pii.gazetteer({"Asha Rao": "PERSON", "Delhi": "GPE"})
    df = spark.createDataFrame([("Asha Rao in Delhi",), (None,)], "text string")
    assert [(r.entity, r.start, r.end, r.score) for r in pii.analyze(df, recognizers=[own]).collect()] == [("PERSON", 0, 8, 0.65), ("GPE", 12, 17, 0.65)]
    assert [r.entity for r in pii.analyze(df, recognizers=[own], entities=["GPE"]).collect()] == ["GPE"]


@pytest.mark.parametrize("s", ["a b", " a", "a ", "a  b", "", " ", "  ", "a b  ", "x\ty z"])
def test_whitespace_tokens_equal_model(spark, s):
    want = [p if p else " " for p in s.split(" ")]
    want = want[:-1] if want[-1] == " " else want
    row = spark.createDataFrame([(s,)], "s string").select(text.whitespace_tokens(F.col("s")).alias("t"), text.join_words(text.whitespace_tokens(F.col("s")), text.whitespace_flags(F.col("s"))).alias("back")).first()
    assert row.t == want
    if "  " not in s and s.strip(" ") == s:
        assert row.back == s


def test_mapping_numbers(spark):
    """24.24 / 33.33 / 42.42 percent and an effort of 1.6061 of 8, 11 and 14 fields; disjoint lists; an empty level."""
    rows = [("Catalog", f"s{i}", None, None, k, None) for i, k in enumerate(["Exact"] * 8 + ["Partial match"] * 11 + ["No match"] * 14)]
    rows += [("Distribution", "a", None, None, "exact", None)] * 2
    df = spark.createDataFrame(rows, "level string, source_field string, dcat_field string, dc_field string, mapping_type string, action string")
    counts = mapping.bucket_counts(df)
    assert {r.level: (r.exact, r.partial, r.unmapped, r.total) for r in counts.collect()}["Catalog"] == (8, 11, 14, 33)
    assert [round(x, 2) for x in mapping.coverage(counts).where("level = 'Catalog'").select("exact", "partial", "unmapped").first()] == [24.24, 33.33, 42.42]
    assert {r.level: round(r.TES, 4) for r in mapping.effort_score(counts).collect() if r.TES is not None and r.level != "Dataset"} == {"Catalog": 1.6061, "Distribution": 0.0}


def test_projections(spark):
    df = spark.createDataFrame([("t", "http://f", None, "text/csv", "10")], "title string, datafile string, datafile_url string, file_format string, file_size string")
    dcat, dublin = transform.to_dcat(df).first(), transform.to_dublin_core(df).first()
    assert (dcat["dcat:downloadURL"], dcat["dcat:mediaType"], dcat["dcterms:title"]) == ("http://f", "text/csv", None)
    assert (dublin["Title"], dublin["Relation [datafile]"], dublin["Format/Media Size"]) == ("t", "http://f", "text/csv")


def test_link_status_probes_each_link_once(spark, tmp_path):
    df = spark.createDataFrame([("a", "b"), ("a", None), ("c", "a")], "x string, y string")
    log = tmp_path / "log"

    def client(url):
        with open(log, "a") as f:
            f.write(url + "\n")
        return 200 if url == "a" else "Error: no"

    got = {r.status: r["count"] for r in links.status_histogram(links.link_status(links.links(df, ["x", "y"]), client, 2)).collect()}
    assert got == {"200": 3, "Error: no": 2}
    assert sorted(log.read_text().split()) == ["a", "b", "c"]


def test_download_reports_each_row(spark, tmp_path):
    df = spark.createDataFrame([(0, "u/x.csv"), (1, "v/x.csv"), (2, None), (3, "w/"), (4, "bad")], "i long, url string")

    def client(url):
        if url == "bad":
            raise OSError("gone")
        return [b"12", b"345"]

    got = {r["index"]: r for r in links.download(df, "url", "i", str(tmp_path / "d"), client, 2).collect()}
    assert [got[i].filename for i in range(4)] == ["x.csv", "1_x.csv", "downloaded_file_2", "downloaded_file_3"]
    assert [got[i].status for i in range(5)] == ["downloaded", "downloaded", "failed", "downloaded", "failed"]
    assert (tmp_path / "d" / "1_x.csv").read_bytes() == b"12345" and got[4].error == "gone"


def test_csv_reader(spark, tmp_path):
    (tmp_path / "a?b.csv").write_bytes("﻿x,y\n1,NA\n\"a\"\"b\",\n".encode())
    (tmp_path / "aXb.csv").write_text("x,y\n9,9\n")
    (tmp_path / "cr.csv").write_bytes(b"x,y\r1,2\r3,4\r")
    df = files.read_csv(spark, str(tmp_path / "a?b.csv"), order="ord")
    assert [(r.x, r.y) for r in df.orderBy("ord").collect()] == [("1", None), ('a"b', None)]
    assert files.read_csv(spark, str(tmp_path / "cr.csv")).count() == 2


def test_csv_writer_and_sql(spark, tmp_path):
    df = spark.createDataFrame([("Catalog", 1)], "level string, n int")
    files.write_csv(df, str(tmp_path / "o"), index="level", single=True)
    assert next((tmp_path / "o").glob("*.csv")).read_text().splitlines() == [",n", "Catalog,1"]
    files.write_csv(df, str(tmp_path / "p"))
    assert files.sql_over_csv(spark, str(tmp_path / "p"), "select level, n + 1 as m from {source}").first().m == 2


def test_relational(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "x"), ("b", None), (None, "2.7")], "k string, v string")
    assert [tuple(r) for r in relational.value_counts(df, "k").collect()] == [("a", 2), ("b", 1)]
    assert [r.v for r in relational.to_int(df, "v").collect()] == [1, 0, 0, 2]
    assert relational.numeric_columns(relational.to_int(df, "v")) == ["v"]


def test_first_row_and_literal_texts(spark):
    df = files.texts(spark, ["b", None, "a"])
    assert relational.first_row(df.where("text is not null"), "text") == {"text": "a"} and relational.first_row(df.limit(0), "text") is None
    assert [r.text for r in df.collect()] == ["b", None, "a"]


def test_inferred_types(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b,c,d,e,f\n1,1.5,x,NA,007,1\n-2,3e2,2,,8,99999999999999999999\nNULL, 4 ,,n/a,9,2\n")
    df = files.read_csv(spark, str(tmp_path / "x.csv"), infer=True)
    assert df.dtypes == [("a", "bigint"), ("b", "double"), ("c", "string"), ("d", "string"), ("e", "bigint"), ("f", "double")]
    assert [tuple(r) for r in df.select("a", "b", "c", "d", "e").collect()] == [(1, 1.5, "x", None, 7), (-2, 300.0, "2", None, 8), (None, 4.0, None, None, 9)]
    assert files.read_csv(spark, str(tmp_path / "x.csv")).dtypes == [(c, "string") for c in "abcdef"]


def test_sheets_of_a_folder(spark, tmp_path):
    (tmp_path / "Catalog.csv").write_text("Equivalent own Metadata,DCAT v3 Mapping,Dublin Core Element,Mapping Type,Notes/Action\ntitle,dct:title,dc:title,Exact,keep\nnote,,,,\n")
    (tmp_path / "Dataset.csv").write_text("Equivalent own Metadata,DCAT v3 Mapping,Dublin Core Element,Mapping Type\n,dcat:theme,NA,No match\n")
    table = mapping.sheets(files.read_sheets(spark, str(tmp_path), ["Catalog", "Dataset"]))
    assert sorted((tuple(r) for r in table.collect()), key=repr) == [("Catalog", "title", "dct:title", "dc:title", "Exact", "keep"), ("Dataset", None, "dcat:theme", None, "No match", None)]
    assert [(r["Metadata Level"], r["Standard Field"]) for r in mapping.proposed_fields(table).collect()] == [("Dataset", "dcat:theme")]
    with pytest.raises(KeyError):
        mapping.sheet(files.texts(spark, ["x"]), "Catalog")


def test_logs(spark, tmp_path):
    df = spark.createDataFrame([("200", 3), ("Error: no", 5), ("404", 3)], "status string, count long")
    files.write_link_log(df, str(tmp_path / "links.log"), datetime(2024, 1, 2, 3, 4, 5))
    files.write_link_log(df.where("count = 5"), str(tmp_path / "again.log"), datetime(2024, 1, 2, 3, 4, 5))
    head = ["Link Statistics Log", "Generated on: 2024-01-02 03:04:05", "", "HTTP Response Code Counts:"]
    assert (tmp_path / "links.log").read_text().splitlines() == [*head, "- Error: no: 5", "- 200: 3", "- 404: 3"]
    assert (tmp_path / "again.log").read_text().splitlines() == [*head, "- Error: no: 5"]
    lists = spark.createDataFrame([("Catalog", ["dcat:a", "dcat:b"], [])], "level string, dcat array<string>, dublin array<string>")
    counts = spark.createDataFrame([("Catalog", 1, 2, 3, 6)], "level string, exact long, partial long, unmapped long, total long")
    for _ in range(2):
        files.append_mapping_log(lists, counts, mapping.effort_score(counts), str(tmp_path / "map.log"))
    one = ["### Proposed New Fields", "", "#### DCAT v3", "- Catalog (2): dcat:a, dcat:b", "", "#### Dublin Core", "- Catalog (0): None", "", "### Transformation Stats", "", "- Catalog: Exact=1, Partial=2, Unmapped=3, Total=6", "", "- TES Catalog: 1.83", ""]
    assert (tmp_path / "map.log").read_text() == ("\n".join(one) + "\n") * 2


def test_shared_folder_is_needed_on_a_cluster(spark, monkeypatch):
    given = files.shared_folder(spark)
    assert given == spark.conf.get("spark.checkpoint.dir")

    class Other:
        conf = SimpleNamespace(get=lambda *_: None)
        sparkContext = SimpleNamespace(getCheckpointDir=lambda: None, master="local-cluster[2,1,1024]", applicationId="x")

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        files.shared_folder(Other)
    Other.sparkContext.master = "local[4]"
    assert files.shared_folder(Other).startswith("file://")
    Other.sparkContext.getCheckpointDir = lambda: "hdfs://x/y/"
    assert files.shared_folder(Other) == "hdfs://x/y"


def test_a_failing_model_costs_its_own_spans_alone(spark):
    def spans(texts):
        for t in texts:
            if "boom" in t:
                raise ValueError("no " + t)
            yield [("GPE", t.index("Delhi"), t.index("Delhi") + 5)] if "Delhi" in t else []

    own = [*pii.DEFAULT, pii.ModelRecognizer(spans)]
    df = spark.createDataFrame([(1, "in Delhi 9783025207"), (2, "boom Delhi 9783025207"), (3, None), (4, "Delhi")], "id int, text string").coalesce(1)
    got = sorted((r.id, r.entity, r.start) for r in pii.analyze(df, recognizers=own, keep=["id"]).collect())
    assert got == [(1, "GPE", 3), (1, "INDIAN_PHONE_NUMBER", 9), (2, "INDIAN_PHONE_NUMBER", 11), (4, "GPE", 0)]
    assert [tuple(r) for r in pii.failures(df, recognizers=own, keep=["id"]).collect()] == [(2, "boom Delhi 9783025207", "ValueError: no boom Delhi 9783025207")]
    assert pii.failures(df, keep=["id"]).count() == 0
    assert {r.id: r.anonymized for r in pii.anonymize(df, recognizers=own).collect()}[2] == "boom Delhi <INDIAN_PHONE_NUMBER>"


def test_overlapping_spans_are_redacted_once(spark):
    own = [pii.Recognizer("A", "ab"), pii.Recognizer("B", "abc"), pii.Recognizer("C", "cd", score=0.5), pii.Recognizer("D", "abc", score=0.95)]
    assert pii.anonymize(spark.createDataFrame([("xabcd abd",)], "text string"), recognizers=own).first().anonymized == "x<D>d <A>d"


TOKENIZER = text.RuleTokenizer()


@pytest.mark.parametrize(
    ("tokenizer", "s", "want"),
    [
        (TOKENIZER, "hello-world. :)", [("TOKEN", "hello"), ("INFIX", "-"), ("TOKEN", "world."), ("SPECIAL-1", ":)")]),
        (TOKENIZER, '("a~b', [("PREFIX", "("), ("PREFIX", '"'), ("TOKEN", "a"), ("INFIX", "~"), ("TOKEN", "b")]),
        (TOKENIZER, "[https://x.y/a-b) -", [("PREFIX", "["), ("URL_MATCH", "https://x.y/a-b)"), ("INFIX", "-")]),
        (TOKENIZER, " \t\n", []),
        (TOKENIZER.with_suffixes(r"[.,]", r"\)"), "(end.), :),", [("PREFIX", "("), ("TOKEN", "end"), ("SUFFIX", "."), ("SUFFIX", ")"), ("SUFFIX", ","), ("SPECIAL-1", ":)"), ("SUFFIX", ",")]),
        (TOKENIZER.with_suffixes(r"[.,]", r"\)").without_suffix(r"\)"), "end). x.", [("TOKEN", "end)"), ("SUFFIX", "."), ("TOKEN", "x"), ("SUFFIX", ".")]),
        (TOKENIZER.with_suffixes(r"-+"), "wait--", [("TOKEN", "wait"), ("SUFFIX", "--")]),
        (TOKENIZER.with_infix(text.KEEP_HYPHENS), "mother-in-law a,b 3*4 x=y wait...what", [("TOKEN", "mother-in-law"), ("TOKEN", "a"), ("INFIX", ","), ("TOKEN", "b"), ("TOKEN", "3"), ("INFIX", "*"), ("TOKEN", "4"), ("TOKEN", "x"), ("INFIX", "="), ("TOKEN", "y"), ("TOKEN", "wait"), ("INFIX", "..."), ("TOKEN", "what")]),
        (TOKENIZER.with_infix(None), "a-b", [("TOKEN", "a-b")]),
        (text.RuleTokenizer(cases={"gimme": ("gim", "me")}), "(gimme gimme!", [("PREFIX", "("), ("SPECIAL-1", "gim"), ("SPECIAL-2", "me"), ("TOKEN", "gimme!")]),
    ],
)
def test_explain(tokenizer, s, want):
    assert tokenizer.explain(s) == want


def test_rule_tokens_equal_explain(spark, monkeypatch):
    monkeypatch.setattr(text, "_KNOWN", 3)
    monkeypatch.setattr(text, "_SLICE", 100)
    tokenizer = TOKENIZER.with_suffixes(r"[.,;!?]")
    own = ["hello-world. :)", "", None, "a a a-b! é\u2003x", " ", "x" * 5000, "(a) (a) b,"] * 30
    rows = text.rule_tokens(spark.createDataFrame(list(enumerate(own)), "i int, text string"), tokenizer).collect()
    assert all((None if r.tokens is None else [tuple(t) for t in r.tokens]) == (None if own[r.i] is None else tokenizer.explain(own[r.i])) for r in rows) and len(rows) == len(own)
    assert text.rule_tokens(files.texts(spark, ["x"]).limit(0), tokenizer).count() == 0


@pytest.mark.parametrize("kind", ["rules", "pieces"])
def test_memory_of_pieces_is_bounded(spark, monkeypatch, kind):
    """What is returned at once follows the bytes of its own texts, also where long ones come together; what is remembered, the bytes of pieces."""
    monkeypatch.setattr(text, "_SLICE", 1000)
    monkeypatch.setattr(text, "_KNOWN_MB", 0.005, raising=False)
    made, known = [], []
    monkeypatch.setattr(text.F, "arrow_udf", lambda _: lambda f: made.append(f) or (lambda c: c))
    clear = text._Pieces.clear
    monkeypatch.setattr(text._Pieces, "clear", lambda self: (known.append(self), clear(self)))
    df = files.texts(spark, ["x"])
    text.rule_tokens(df, TOKENIZER) if kind == "rules" else text.wordpieces(df, ["a", "x", "##x"])
    own = ["a b", None, ""] * 300 + [f"{'y' * 390}{i} x xx" for i in range(100)] + ["x" * 5000, "a"]
    given = [None if t is None else t.split() for t in own] if kind == "pieces" else own
    type_ = pa.list_(pa.string()) if kind == "pieces" else pa.string()
    at = 0
    for part in made[0](iter([pa.array([], type_), pa.array(given, type_), pa.array([None], type_)])):
        texts = (own + [None])[at : at + len(part)]
        want = [None if t is None else TOKENIZER.explain(t) if kind == "rules" else [p for w in t.split() for p in ((["x"] + ["##x"] * (len(w) - 1)) if set(w) == {"x"} else ["a"] if w == "a" else ["[UNK]"])] for t in texts]
        assert (part.to_pylist() if kind == "pieces" else [None if v is None else [tuple(r.values()) for r in v] for v in part.to_pylist()]) == want
        assert len(part) == 1 or sum(len((t or "").replace(" ", "")) for t in texts) <= 1000
        assert sum(map(len, known[0].known)) <= 12_000
        at += len(part)
    assert at == len(own) + 1


def test_wordpieces(spark):
    df = files.texts(spark, ["Unaffable un, xyz", None, ""])
    got = [r.pieces for r in text.wordpieces(df, ["un", "##aff", "##able", ","]).collect()]
    assert got == [["un", "##aff", "##able", "un", ",", "[UNK]"], None, []]
    assert [r.pieces for r in text.wordpieces(df, [], fold=False).collect()] == [["[UNK]"] * 4, None, []]


def test_annotations(spark):
    rows = text.annotate(files.texts(spark, ["a bc", None]), lambda texts: ([{"lemma": w.upper(), "n": len(w)} for w in t.split()] for t in texts), "lemma string, n int").collect()
    assert [[tuple(a) for a in r.annotations] for r in rows] == [[("A", 1), ("BC", 2)], []]


@pytest.fixture(scope="module")
def server():
    class Handler(BaseHTTPRequestHandler):
        def answer(self, body: bool):
            if self.path == "/slow":
                time.sleep(3)
            code = {"/gone": 404, "/moved": 302, "/broken": 500}.get(self.path, 200)
            self.send_response(code)
            self.send_header("Content-Length", "20000" if code == 200 else "0")
            if code == 302:
                self.send_header("Location", "/there")
            self.end_headers()
            if body and code == 200:
                self.wfile.write(b"x" * 20000)

        def do_HEAD(self):
            self.answer(False)

        def do_GET(self):
            self.answer(True)

        def log_message(self, *_):
            pass

    with ThreadingHTTPServer(("127.0.0.1", 0), Handler) as httpd:
        threading.Thread(target=httpd.serve_forever, daemon=True).start()
        yield f"http://127.0.0.1:{httpd.server_port}"
        httpd.shutdown()


def test_requests(server):
    assert [links.http_status(server + p) for p in ("/a", "/moved", "/gone", "/broken")] == ["200", "200", "404", "500"]
    assert links.http_status(server + "/slow", timeout=0.3).startswith("Error: ") and links.http_status("http://127.0.0.1:1/").startswith("Error: ")
    for url in ("file:///etc/hostname", "ftp://x/y", "x", ""):
        assert links.http_status(url) == "Error: neither http nor https"
    chunks = list(links.http_get(server + "/a"))
    assert b"".join(chunks) == b"x" * 20000 and max(map(len, chunks)) <= links.CHUNK
    with pytest.raises(ValueError):
        next(links.http_get("file:///etc/hostname"))
    with pytest.raises(OSError):
        next(links.http_get(server + "/slow", timeout=0.3))


def test_downloads_over_http(spark, server, tmp_path):
    df = spark.createDataFrame([(1, server + "/a.csv"), (2, server + "/gone"), (3, "file:///etc/hostname")], "i long, url string")
    got = {r["index"]: r for r in links.download(df, "url", "i", f"file://{tmp_path}/d").collect()}
    assert [(got[i].status, got[i].bytes) for i in (1, 2, 3)] == [("downloaded", 20000), ("failed", 0), ("failed", 0)]
    assert sorted(p.name for p in (tmp_path / "d").iterdir()) == ["a.csv"]


def test_names_stay_in_the_folder_and_apart(spark, tmp_path):
    urls = ["u/..", "u/.", "u/..", "u/x\\..\\y", "u/a\x00b", "u/x.csv", "v/x.csv", "w/6_x.csv", None, "u/..%2f"]
    df = spark.createDataFrame(list(enumerate(urls)), "i long, url string")
    folder = tmp_path / "in" / "d"
    got = {r["index"]: r for r in links.download(df, "url", "i", str(folder), lambda url: [url.encode()]).collect()}
    done = [r for r in got.values() if r.status == "downloaded"]
    assert len(done) == 9 and len({r.filename for r in done}) == 9 and got[8].error == "no link"
    assert {p.name for p in folder.iterdir()} == {r.filename for r in done} and [p.name for p in (tmp_path / "in").iterdir()] == ["d"]
    assert all((folder / r.filename).read_bytes() == urls[r["index"]].encode() for r in done)
    assert got[5].filename == "x.csv" and got[7].filename == "6_x.csv" and got[6].filename not in ("x.csv", "6_x.csv")


def test_null_links_keep_their_rows(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "url string, n int")
    rows = links.link_status(df, lambda url: "200")
    assert sorted((r.n, r.status) for r in rows.collect()) == [(1, "200"), (2, None)] and [tuple(r) for r in links.status_histogram(rows).collect()] == [("200", 1)]


def test_streams_equal_batch(spark, tmp_path):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    rows.write.parquet(str(tmp_path / "in"))
    stream = streams.pii_spans(streams.read_stream(spark, str(tmp_path / "in"), rows.schema))
    query = stream.writeStream.format("memory").queryName("spans").start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("spans").count() == pii.analyze(rows).count()
