"""OCR clients and cache, uploads, settings, streaming, nested records, references."""

import json

import pytest
from pyspark.sql import functions as F

from folioflow.config import Config
from folioflow.functions.names import file_key
from folioflow.operators import nested, references
from folioflow.sinks.storage import Storage, media_type, visitor_token
from folioflow.sources import ocr
from folioflow.streaming import ingest


def test_normalise_falls_through_empty_names():
    r = ocr.normalise(json.dumps({"md_results": "", "markdown": "m", "layout": [[{"type": "table", "box": [1, 2, 3, 4]}, None], {"bbox": [1], "text": "x"}, {"bbox": [0, 0, 1, 1]}]}))
    assert r["markdown"] == "m"
    assert [(e["label"], e["bbox"]["x1"]) for e in r["elements"]] == [("table", 3.0), ("text", 1.0)]
    assert ocr.normalise(None)["elements"] == [] and ocr.normalise("{cut")["markdown"] == ""


def test_cache_asks_only_for_misses(spark, tmp_path):
    import datetime as dt

    images = spark.createDataFrame([("d", p, dt.datetime(2025, 1, 1), bytearray(b"x")) for p in (1, 2, 3)], "doc_id string, page int, modified timestamp, image binary")
    client = ocr.MockClient(lambda image, page: json.dumps({"md": f"page {page}", "layout": []}))
    first = ocr.with_cache(images.filter("page < 3"), None, Config(), client=client)
    ocr.cache_rows(first).write.parquet(str(tmp_path / "c"))
    cache = spark.read.parquet(str(tmp_path / "c"))
    never = ocr.MockClient(lambda image, page: json.dumps({"md": "fresh"}))
    got = {r.page: json.loads(r.response)["md"] for r in ocr.with_cache(images, cache, Config(), client=never).collect()}
    assert got == {1: "page 1", 2: "page 2", 3: "fresh"}


def test_config():
    c = Config.from_env({"FOLIOFLOW_PAGE_DPI": "x", "FOLIOFLOW_TIMEOUT_S": "9", "FOLIOFLOW_TABLE_RESCUE": "off", "FOLIOFLOW_BACKEND": "http"})
    assert (c.page_dpi, c.timeout_s, c.table_rescue) == (200, 9, False)
    assert Config.from_env({"FOLIOFLOW_CA_BUNDLE": "/x"}).ca_bundle == "/x"
    with pytest.raises(ValueError):
        c.validate()
    assert isinstance(ocr.make_client(Config()), ocr.MockClient)


class Http:
    """Answers by the end of the address; keeps what was sent."""

    def __init__(self, **answers):
        self.answers, self.calls = answers, []

    def _answer(self, method, url, **kw):
        self.calls.append((method, url, kw))
        status, body = self.answers[url.rsplit("/", 1)[-1].replace("-", "_")]

        class A:
            status_code, headers = status, {"ETag": f"e{len(self.calls)}"}
            json = staticmethod(lambda: body)

        return A

    def post(self, url, **kw):
        return self._answer("post", url, **kw)

    def put(self, url, **kw):
        return self._answer("put", url, **kw)

    def get(self, url, **kw):
        return self._answer("get", url, **kw)

    def sent(self, end):
        return [kw["json"] for _, url, kw in self.calls if url.endswith(end)]


DONE = (200, {"success": True, "file": {"id": "7", "url": "http://s/7"}})


def test_upload(tmp_path):
    f = tmp_path / "a.json"
    f.write_text("{}")
    http = Http(init=(200, {"success": True, "type": "single", "upload_url": "http://s/raw", "headers": {"X-A": ["1"]}, "r2_key": "k"}), raw=(200, {}), confirm=DONE)
    s = Storage("http://s/api/", visitor="v", session=http)
    assert s.upload(f, "c")["url"] == "http://s/7" and http.calls[0][2]["headers"] == {"X-Visitor-Token": "v"}
    about = {"filename": "a.json", "content_type": "application/json", "size": 2}
    assert http.sent("/init") == [about] and http.sent("/confirm") == [{**about, "r2_key": "k", "collection_id": "c"}]
    assert http.calls[1][2]["headers"] == {"Content-Type": "application/json", "X-A": "1"}
    assert Storage("b", "t", "v", http).headers() == {"Authorization": "Bearer t"}
    for answer, well in (((200, {"status": "ok"}), True), ((200, {"status": "down"}), False), ((500, {"status": "ok"}), False)):
        assert Storage("http://s", session=Http(health=answer)).health() is well
    with pytest.raises(RuntimeError):
        Storage("http://s", session=Http(collection=(200, {"success": False}))).create_collection()
    new = Http(collection=(200, {"collection": {"id": "c", "url": "u"}}))
    assert Storage("http://s", session=new).create_collection(2)["id"] == "c" and new.sent("/collection") == [{"expected_file_count": 2}]
    assert media_type("x.PDF") == "application/pdf" and visitor_token(tmp_path) == visitor_token(tmp_path)


def test_upload_in_parts(tmp_path):
    f = tmp_path / "a.bin"
    f.write_bytes(b"abcde")
    plan = {"type": "multipart", "upload_id": "u", "r2_key": "k", "total_parts": 3, "part_size": 2, "initial_urls": {"1": "http://s/raw"}}
    http = Http(init=(200, plan), parts=(200, {"part_urls": [{"partNumber": 2, "url": "http://s/raw"}, {"partNumber": 3, "url": "http://s/raw"}]}), raw=(200, {}), complete_multipart=(200, {}), confirm=DONE)
    assert Storage("http://s", session=http).upload(f)["id"] == "7"
    assert [kw["data"] for m, _, kw in http.calls if m == "put"] == [b"ab", b"cd", b"e"]
    assert http.sent("/parts") == [{"upload_id": "u", "part_numbers": [2]}]
    (whole,) = http.sent("/complete-multipart")
    assert whole["upload_id"] == "u" and [p["partNumber"] for p in whole["parts"]] == [1, 2, 3] and http.sent("/confirm")[0]["r2_key"] == "k"


def test_stream_equals_batch(spark, tmp_path):
    import datetime as dt

    rows = [(i, "d", i, f"{i} Find x [2]\n(a) more [1]", dt.datetime(2025, 1, 1 + i)) for i in range(1, 5)]
    pages = spark.createDataFrame(rows + rows[:2], "page_id bigint, doc_id string, page int, markdown string, loaded_at timestamp")
    pages.write.parquet(str(tmp_path / "in"))
    parts = ingest.stream_parts(ingest.page_stream(spark, str(tmp_path / "in"), pages.schema))
    ingest.write_stream(parts, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 8
    days = ingest.parts_by_day(spark.read.parquet(str(tmp_path / "out")))
    assert sorted((r.parts, r.marks) for r in days.collect()) == [(2, 3)] * 4


# -- nested records ------------------------------------------------------------


def test_nodes_of_lists(spark, rows):
    kind = "id bigint, q array<struct<n:string,d:array<string>,node:int>>, id2 string"
    df = spark.createDataFrame([(1, [("a", ["x", None, ""], 5), None, ("b", None, None)], "z"), (2, None, "z"), (3, [], "z"), (1, [("a", ["x", None, ""], 5), None, ("b", None, None)], "z")], kind)
    assert rows(nested.nodes(df, "id", "q", ["d"], "s")) == [("s", 1, "1"), ("s", 1, "1.1"), ("s", 1, "1.2"), ("s", 1, "2")]
    assert rows(nested.child_table(df, "id", "q")) == [(1, "1", None, 1, "a", 5), (1, "2", None, 2, "b", None)]
    assert nested.child_table(df, "id", "q").columns == ["id", "node", "parent_node", "ordinal", "n", "node_"]
    assert rows(nested.child_table(df, "id", "q", ["d"])) == [(1, "1.1", "1", 1, "x"), (1, "1.2", "1", 2, "")]
    assert nested.nodes(df.limit(0), "id", "q", ["d"]).count() == 0


def brute_nodes(raw):
    """All nodes by plain recursion."""

    def loads(s):
        try:
            return json.loads(s)
        except ValueError:
            return None

    def layout(v):
        if isinstance(v, str):
            return layout(loads(v)) if v.lstrip()[:1] in tuple('{["') else None
        if isinstance(v, dict):
            for x in (v.get("layout_details"), v.get("layout")):
                x = loads(x) if isinstance(x, str) else x
                if isinstance(x, list):
                    return x
        return next((x for y in (v.values() if isinstance(v, dict) else v if isinstance(v, list) else ()) if (x := layout(y)) is not None), None)

    def objects(v):
        return [o for x in v for o in ([x] if isinstance(x, dict) else objects(x) if isinstance(x, list) else [])]

    def records(o):
        return next((x for v in o.values() if isinstance(v, list) and (x := [y for y in v if isinstance(y, dict)])), [])

    out = []
    for i, e in enumerate(objects((layout(loads(raw)) if raw else None) or []), 1):
        out.append(f"{i}")
        for j, a in enumerate(records(e), 1):
            out += [f"{i}.{j}", *(f"{i}.{j}.{k}" for k, _ in enumerate(records(a), 1))]
    return out


def deep(v, n, text=False):
    for i in range(n):
        v = {"x": v} if i % 2 else [v]
        v = json.dumps(v) if text and i % 9 == 0 else v
    return v


def test_response_nodes(spark, rows):
    inner = {"layout": [{"bbox": [1, 2], "words": [None, {"t": "a", "alts": [{"t": "b"}, None, {"t": "c"}]}, {"t": "d"}]}, [None, {"label": "x"}, []]]}
    raws = {1: json.dumps(inner), 2: json.dumps({"code": 0, "data": json.dumps(inner)}), 3: json.dumps(json.dumps(inner)), 4: None, 5: "{cut", 6: '{"error": "x"}', 7: json.dumps({"response": {"data": {"layout_details": [[], None]}}}), 8: ""}
    same = (1, 2, 3, 9, 10, 11)
    raws |= {9: json.dumps(deep(inner, 7)), 10: json.dumps(deep(inner, 60)), 11: json.dumps({"a": {"b": deep(inner, 20, True)}}), 12: json.dumps({"layout": deep([{"a": 1}, {"b": [{"c": 2}]}], 40, False)}), 13: json.dumps({"layout": deep([{"a": 1}], 3)[0]})}
    df = spark.createDataFrame(list(raws.items()), "raw_id bigint, raw string")
    want = ["1", "1.1", "1.1.1", "1.1.2", "1.2", "2"]
    got = nested.response_nodes(df)
    by_raw = {i: sorted(n for _, x, n in rows(got) if x == i) for i in raws}
    assert all(by_raw[i] == want for i in same) and not any(by_raw[i] for i in (4, 5, 6, 7, 8))
    assert by_raw[12] == sorted(brute_nodes(raws[12])) and by_raw[13] == sorted(brute_nodes(raws[13]))
    typed = {r.raw_id: r.layout for r in nested.decoded(df).collect()}
    assert typed[1] == typed[10] == typed[11] and typed[1][0].items[0].text == "a" and typed[1][0].x0 == 1.0
    real = spark.read.parquet("/root/testdata/sf0.001/ocr_raw.parquet").select("raw_id", "raw").distinct()
    brute = sorted({("ocr_raw", r.raw_id, n) for r in real.collect() for n in brute_nodes(r.raw)}, key=repr)
    assert rows(nested.response_nodes(real)) == brute


# -- references -----------------------------------------------------------------


@pytest.mark.parametrize("name", ["a_p1_fig1.png", " A_P1_FIG1.PNG ", "/srv/x/a_p1_fig1.png", "D:\\s\\A_p1_fig1.png", "./a%5Fp1%5Ffig1.png", "a_p1_fig1%2Epng", "store:/a_p1_fig1.png#crop", "a_p1_fig1.png?v=7", "ａ_p1_fig1.png", "\u200ba_p1_fig1.png", "а_p1_fig1.png"])
def test_file_key(spark, name):
    assert spark.createDataFrame([(name,)], "v string").select(file_key(F.col("v")).alias("k")).first().k == "a_p1_fig1.png"


def test_odd_names(spark):
    df = spark.createDataFrame([(None,), ("",), ("100%",), ("a+b.png",), ("/x/",)], "v string")
    assert [r.k for r in df.select(file_key(F.col("v")).alias("k")).collect()] == [None, "", "100%", "a+b.png", "x"]


def test_dangling(spark, rows):
    import datetime as dt

    day = lambda n: dt.datetime(2025, 1, n)
    targets = spark.createDataFrame([("a", day(5), day(10)), ("a", day(5), day(10)), ("a", day(20), None), ("b", day(15), None), ("c", day(1), day(2))], "key string, start timestamp_ntz, end timestamp_ntz")
    refs = [("a", day(5)), ("a", day(9)), ("a", day(10)), ("a", day(25)), ("a", day(4)), ("b", day(14)), ("b", day(15)), ("c", day(2)), ("z", day(3)), ("a", None)]
    r = spark.createDataFrame([("s", i, 1, k, at) for i, (k, at) in enumerate(refs)] * 2, "src string, rec_id bigint, pos int, key string, at timestamp_ntz")
    want = [("s", 2, 1, "deleted", "2025-01"), ("s", 4, 1, "late", "2025-01"), ("s", 5, 1, "late", "2025-01"), ("s", 7, 1, "deleted", "2025-01"), ("s", 8, 1, "missing", "2025-01"), ("s", 9, 1, "deleted", None)]
    assert rows(references.dangling(r, targets)) == want
    assert rows(references.dangling(r, targets, max_bits=1024)) == want
    assert {x.reason for x in references.dangling(r, targets.limit(0)).collect()} == {"missing"}
    assert references.dangling(r.limit(0), targets).count() == 0
