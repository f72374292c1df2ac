"""OCR as a table function: clients, the response cache, normalised responses."""

from __future__ import annotations

import base64
import json
from collections import deque
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.config import Config
from folioflow.functions import responses as r
from folioflow.functions.text import cache_key
from folioflow.operators.nested import _box, _layout, _loads, _objects, _text, with_deep_ones
from folioflow.schemas import CACHE, ELEMENT


class Client(Protocol):
    def parse(self, image: bytes, page: int) -> str:
        """The response text for one page or clip."""


class MockClient:
    """Answers by a handler; without one every page is empty."""

    def __init__(self, handler: Callable[[bytes, int], str] | None = None):
        self.handler = handler or (lambda image, page: json.dumps({"md_results": "", "layout_details": []}))

    def parse(self, image: bytes, page: int) -> str:
        return self.handler(image, page)


class HttpClient:
    """Posts the image as a data address; a refused PNG is tried again as JPEG. One session per partition."""

    def __init__(self, config: Config):
        import requests

        self.config, self.session = config, requests.Session()
        self.session.headers["Authorization"] = f"Bearer {config.api_key}"
        if config.ca_bundle:
            self.session.verify = config.ca_bundle

    def parse(self, image: bytes, page: int) -> str:
        status = None
        for kind in ("image/png", "image/jpeg"):
            body = image if kind == "image/png" else _as_jpeg(image)
            if body is None:
                break
            url = f"data:{kind};base64,{base64.b64encode(body).decode()}"
            answer = self.session.post(f"{self.config.base_url}/layout_parsing", json={"file": url, **({"model": self.config.model} if self.config.model else {})}, timeout=self.config.timeout_s)
            status = answer.status_code
            if status < 400:
                return answer.text
        raise RuntimeError(f"page {page}: the service answered {status}")


def _as_jpeg(image: bytes) -> bytes | None:
    try:
        import io

        from PIL import Image
    except ImportError:
        return None
    out = io.BytesIO()
    Image.open(io.BytesIO(image)).convert("RGB").save(out, "JPEG", quality=92)
    return out.getvalue()


def make_client(config: Config) -> Client:
    return MockClient() if config.backend == "mock" else HttpClient(config)


def normalise(raw: str | None) -> dict:
    """markdown and elements of a response under any of its field names. Empty values fall through to the next name.

    Elements without a box of four numbers are left out; a missing label is `text`.
    """
    v = _loads(raw) if raw else None
    elements = []
    for o in _objects(_layout(v) or []):
        b = _box(o)
        if b and len(b) == 4:
            elements.append({"label": _text(o, r.LABEL) or "text", "bbox": dict(zip(("x0", "y0", "x1", "y1"), b)), "content": _text(o, r.CONTENT)})
    return {"markdown": _markdown(v), "elements": elements, "raw": raw}


def _markdown(v) -> str:
    """The text of the first object, level by level, that has one or a layout."""
    open_ = deque([v])
    while open_:
        v = open_.popleft()
        if isinstance(v, str) and v.lstrip()[:1] in ("{", "[", '"'):
            open_.append(_loads(v))
        elif isinstance(v, dict):
            own = _text(v, r.MARKDOWN)
            if own is not None or any(n in v for n in r.LAYOUT):
                return own or ""
            open_.extend(v[k] for k in sorted(v))
        elif isinstance(v, list):
            open_.extend(v)
    return ""


def normalised(responses: DataFrame, key: str = "raw_id", column: str = "raw") -> DataFrame:
    """(key, markdown, elements) of each response; a null or broken one is an empty page."""
    c = F.col(column)
    read = responses.select(key, c.alias("raw_"), r.layout(c).alias("l_"), r.markdown(c).alias("m_"))
    deep = F.coalesce(F.col("l_.deep") | F.col("m_.deep"), F.lit(False))
    read = read.select(key, F.coalesce("m_.text", F.lit("")).alias("markdown"), F.coalesce(r.boxed_elements(F.col("l_.elements")), F.array().cast(f"array<{ELEMENT}>")).alias("elements"), F.when(deep, F.col("raw_")).alias("raw_"))
    return with_deep_ones(read, {"markdown": lambda x: normalise(x)["markdown"], "elements": lambda x: normalise(x)["elements"]})


def with_cache(images: DataFrame, cache: DataFrame | None, config: Config, pass_name: str = "pass1", client: Client | None = None, more: tuple[str, ...] = (), in_key: tuple[str, ...] = ()) -> DataFrame:
    """images (doc_id, page, modified, image) with `key` and `response`: from the cache, else from the client.

    Only misses reach the client. The key holds backend and resolution besides
    the file, its time and the page, so results of different backends never mix.
    more: further columns that are kept; in_key: those of them that tell images of one page apart.
    """
    dpi = config.page_dpi if pass_name == "pass1" else config.table_dpi
    keyed = images.withColumn("key", cache_key(F.col("doc_id"), F.col("modified"), F.col("page"), F.lit(pass_name), F.lit(dpi), F.lit(config.backend), *map(F.col, in_key)))
    names = ["key", "doc_id", "page", "modified", *more]
    hits = None
    misses = keyed
    if cache is not None:
        known = cache.select("key", F.col("raw").alias("response")).dropDuplicates(["key"])
        hits = keyed.select(*names).join(known, "key")
        misses = keyed.join(known.select("key"), "key", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = client or make_client(config)
        for b in batches:
            b["response"] = [c.parse(bytes(image), int(page)) for image, page in zip(b.image, b.page)]
            yield b[[*names, "response"]]

    schema = T.StructType([*(keyed.schema[n] for n in names), T.StructField("response", T.StringType())])
    fresh = misses.select(*names, "image").mapInPandas(run, schema)
    return fresh if hits is None else hits.select(fresh.columns).unionByName(fresh)


def cache_rows(responses: DataFrame) -> DataFrame:
    """(key, markdown, elements, raw) to append to the cache table."""
    out = normalised(responses.select("key", "response"), "key", "response").join(responses.select("key", F.col("response").alias("raw")), "key")
    return out.select(*[c.strip().split(" ")[0] for c in ("key", "markdown", "elements", "raw")])


CACHE_SCHEMA = CACHE
