"""What a landing asks of live services: archives, forms behind a session, headers. Runs on the driver, before any table exists."""

from __future__ import annotations

import base64
import os
import re
import shutil
import time
import uuid
from collections.abc import Callable, Mapping
from html.parser import HTMLParser
from http.cookiejar import CookieJar
from typing import BinaryIO
from urllib.parse import urlencode
from urllib.request import HTTPCookieProcessor, Request, build_opener, urlopen

# The size that a whole archive exceeds, the form field of a session's token, and the steps that a clock header is moved by.
LEAST_ARCHIVE = 1_000_000
TOKEN_FIELD = "__RequestVerificationToken"
CLOCK_STEPS = 10


def archive(path: str, url: Callable[[], str], refresh: bool = False, least: int = LEAST_ARCHIVE, open_url: Callable[[str], BinaryIO] = lambda u: urlopen(u, timeout=180)) -> str:
    """``path``, downloaded from what ``url`` says now unless a copy of more than ``least`` bytes is there. A download takes the place of the old copy when it is whole."""
    if not refresh and os.path.exists(path) and os.path.getsize(path) > least:
        return path
    part = f"{path}.{uuid.uuid4().hex}"
    try:
        with open_url(url()) as body, open(part, "wb") as out:
            shutil.copyfileobj(body, out, 1 << 20)
        os.replace(part, path)
    finally:
        if os.path.exists(part):
            os.remove(part)
    return path


def blob_url(base: str, dataset: str, metadata: Mapping[str, str], default_name: str = "archive.zip") -> str:
    """Where a dataset's metadata says that its file is; an error if it has none."""
    blob = metadata.get("blobId")
    if not blob:
        raise ValueError(f"dataset {dataset} has no file")
    return f"{base}/api/views/{dataset}/files/{blob}?{urlencode({'filename': metadata.get('blobFilename') or default_name})}"


def form_field(html: str, name: str) -> str:
    """The value of a page's form field, in whatever order its attributes stand; '' if it lacks."""
    found: list[str] = []

    class Fields(HTMLParser):
        def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
            a = dict(attrs)
            if a.get("name") == name and a.get("value"):
                found.append(a["value"])

    Fields().feed(html)
    return found[0] if found else ""


def post_in_session(page: str, form: str, fields: Mapping[str, str], token: str = TOKEN_FIELD, timeout: float = 30) -> str:
    """The answer to a form: the page is asked first, and its cookies and token go with the form."""
    session = build_opener(HTTPCookieProcessor(CookieJar()))
    with session.open(page, timeout=timeout) as r:
        html = r.read().decode("utf-8", errors="replace")
    data = urlencode({token: form_field(html, token), **fields}).encode()
    with session.open(Request(form, data=data), timeout=timeout) as r:
        return r.read().decode("utf-8", errors="replace")


def clock_header(at: float | None = None, steps: int = CLOCK_STEPS) -> str:
    """The milliseconds of the clock in base64, each character moved down."""
    digits = str(int((time.time() if at is None else at) * 1000))
    return "".join(chr(ord(ch) - steps) for ch in base64.b64encode(digits.encode()).decode())


def quoted(text: object) -> str:
    """A literal of a feed's query language."""
    return "'" + str(text).replace("'", "''") + "'"


def feed_name(name: str) -> str:
    """A feed's name, if it may be one."""
    if not re.fullmatch("[a-z][a-z0-9_]*", name):
        raise ValueError(f"{name!r} is no name: small letters, digits and _, a letter first")
    return name


def feed_module(name: str, about: str = "") -> str:
    """The text of a module with an empty feed: what is left to do is its schema and columns."""
    return f'''"""{about or name}."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.sources.listings import feed, shaped


@feed("{feed_name(name)}")
def {name}(pages: DataFrame) -> DataFrame:
    """pages: text."""
    d = pages.select(F.explode(F.from_json("text", "array<struct<id:string,address:string,unit:string,price:double>>")).alias("i"))
    return shaped(d, "{name}", source_id=F.col("i.id"), address=F.col("i.address"), unit_number=F.col("i.unit"), price=F.col("i.price"), raw_json=F.to_json("i"))
'''
