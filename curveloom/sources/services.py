"""Clients of web services over a transport that is given, so that they run and are tested without a network.

A transport is a function of a Request that returns a Response; `http` is the one that goes out. In a job, lookup() and download()
make one client per task from a factory, so that limits hold per task.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import time
import urllib.error
import urllib.parse
import urllib.request
import uuid
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values.
RETRIED = frozenset((408, 425, 429, 500, 502, 503, 504))
TRIES, BACKOFF = 5, 1.0
INTERVAL, TIMEOUT = 0.25, 60.0
LEAST_PDF, MOST_PDF = 50 * 1024, 100 * 1024 * 1024
PARSE_TIMEOUT, PARSE_TRIES = 180.0, 3
COORDINATES = ("figure", "head", "p", "ref", "s", "table", "formula")
OPEN_ACCESS_WORK = "https://api.unpaywall.org/v2/{doi}"


class ServiceError(RuntimeError):
    """A service gave no usable answer."""


class Rejected(ServiceError):
    """A file was not what was asked for."""


@dataclass
class Request:
    url: str
    method: str = "GET"
    headers: dict[str, str] = field(default_factory=dict)
    body: bytes | None = None
    timeout: float = TIMEOUT


@dataclass
class Response:
    status: int
    body: bytes = b""
    headers: Mapping[str, str] = field(default_factory=dict)
    url: str = ""


Transport = Callable[[Request], Response]


def http(request: Request) -> Response:
    """Sends a request over the network."""
    out = urllib.request.Request(request.url, request.body, request.headers, method=request.method)
    try:
        with urllib.request.urlopen(out, timeout=request.timeout) as r:
            return Response(r.status, r.read(), dict(r.headers), r.url)
    except urllib.error.HTTPError as e:
        return Response(e.code, e.read(), dict(e.headers), request.url)


class RateLimiter:
    """Keeps a least time between calls of one process."""

    def __init__(self, interval: float = INTERVAL, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.interval, self.clock, self.sleep = max(0.0, interval), clock, sleep
        self.last: float | None = None

    def wait(self) -> None:
        if self.last is not None and (left := self.last + self.interval - self.clock()) > 0:
            self.sleep(left)
        self.last = self.clock()


class Session:
    """A transport with a rate limit, and tries that wait longer each time, or as long as the answer says."""

    def __init__(self, transport: Transport = http, limiter: RateLimiter | None = None, tries: int = TRIES, backoff: float = BACKOFF, sleep: Callable[[float], None] = time.sleep):
        self.transport, self.limiter, self.tries, self.backoff, self.sleep = transport, limiter or RateLimiter(), tries, backoff, sleep

    def send(self, request: Request) -> Response:
        for n in range(self.tries + 1):
            self.limiter.wait()
            try:
                found = self.transport(request)
            except OSError as e:
                if n == self.tries:
                    raise ServiceError(f"{request.method} {request.url}: {e}") from e
                found = None
            if found is not None and (found.status not in RETRIED or n == self.tries):
                return found
            asked = (found.headers.get("Retry-After") or "") if found is not None else ""
            self.sleep(float(asked) if asked.isdigit() else self.backoff * 2**n)
        raise AssertionError

    def get_json(self, url: str, params: Mapping[str, object] | None = None, timeout: float = TIMEOUT) -> dict:
        """The object that a GET answers; anything else is a ServiceError."""
        full = url + ("?" + urllib.parse.urlencode(params) if params else "")
        found = self.send(Request(full, headers={"Accept": "application/json"}, timeout=timeout))
        if found.status >= 400:
            raise ServiceError(f"GET {full} returned HTTP {found.status}: {found.body[:500].decode(errors='replace')}".replace("\n", " "))
        try:
            out = json.loads(found.body)
        except ValueError as e:
            raise ServiceError(f"GET {full} did not return JSON") from e
        if not isinstance(out, dict):
            raise ServiceError(f"GET {full} did not return an object")
        return out

    def open_access_record(self, doi: str, email: str) -> dict | None:
        """The open-access record of a DOI, or None if the service has none or fails."""
        try:
            return self.get_json(OPEN_ACCESS_WORK.format(doi=urllib.parse.quote(doi, safe="/")), {"email": email})
        except ServiceError:
            return None


class Parser:
    """A service that turns a PDF into article XML."""

    def __init__(self, base: str, session: Session | None = None, tries: int = PARSE_TRIES, timeout: float = PARSE_TIMEOUT):
        self.base, self.session, self.tries, self.timeout = base.rstrip("/"), session or Session(tries=0), tries, timeout

    def is_alive(self) -> bool:
        try:
            return self.session.send(Request(f"{self.base}/api/isalive", timeout=10)).status < 400
        except ServiceError:
            return False

    def full_text(self, name: str, pdf: bytes, coordinates: bool = True, header: int = 1, citations: int = 0) -> bytes:
        """The article XML of a PDF; a busy service is asked again after 1, 2, ... seconds."""
        fields = [("consolidateHeader", str(header)), ("consolidateCitations", str(citations)), ("includeRawCitations", "1"), ("includeRawAffiliations", "1"), ("segmentSentences", "1")]
        fields += [("teiCoordinates", c) for c in COORDINATES if coordinates]
        mark = uuid.uuid4().hex
        parts = [f'--{mark}\r\nContent-Disposition: form-data; name="{k}"\r\n\r\n{v}\r\n'.encode() for k, v in fields]
        parts.append(f'--{mark}\r\nContent-Disposition: form-data; name="input"; filename="{name}"\r\nContent-Type: application/pdf\r\n\r\n'.encode() + pdf + f"\r\n--{mark}--\r\n".encode())
        request = Request(f"{self.base}/api/processFulltextDocument", "POST", {"Content-Type": f"multipart/form-data; boundary={mark}"}, b"".join(parts), self.timeout)
        last = ""
        for n in range(self.tries):
            try:
                found = self.session.send(request)
                if found.status < 400 and found.body.strip():
                    return found.body
                last = f"HTTP {found.status}" if found.status >= 400 else "an empty answer"
            except ServiceError as e:
                last = str(e)
            if n + 1 < self.tries:
                self.session.sleep(2.0**n)
        raise ServiceError(f"no article XML of {name}: {last}")


PAGE = re.compile(rb"/Type\s*/Page(?![A-Za-z])")


def inspect_pdf(content: bytes, least: int = LEAST_PDF, most: int = MOST_PDF) -> int | None:
    """Pages of a PDF where they can be counted without decoding, else None; Rejected if it is no PDF, or too small or large."""
    if not least <= len(content) <= most:
        raise Rejected(f"{len(content)} bytes are not within {least} to {most}")
    if b"%PDF-" not in content[:1024]:
        raise Rejected("no PDF signature")
    if b"%%EOF" not in content[-2048:]:
        raise Rejected("the end of the PDF is missing")
    return len(PAGE.findall(content)) or None


def fetch_pdf(session: Session, url: str, params: Mapping[str, str] | None = None, least: int = LEAST_PDF, most: int = MOST_PDF) -> dict:
    """Content and description of a PDF at an address; Rejected if the answer is none."""
    full = url + (("&" if "?" in url else "?") + urllib.parse.urlencode(params) if params else "")
    found = session.send(Request(full, headers={"Accept": "application/pdf, application/octet-stream;q=0.9, */*;q=0.1"}))
    if found.status >= 400:
        raise Rejected(f"HTTP {found.status} from {found.url or url}")
    told = found.headers.get("Content-Length") or ""
    if told.isdigit() and int(told) > most:
        raise Rejected(f"declared size {told} exceeds the limit")
    pages = inspect_pdf(found.body, least, most)
    return {
        "content": found.body, "sha256": hashlib.sha256(found.body).hexdigest(), "size_bytes": len(found.body), "page_count": pages,
        "resolved_url": found.url or url, "content_type": found.headers.get("Content-Type"),
    }


def lookup(keys: DataFrame, key: str, ask: Callable[[Session, str], dict | None], session: Callable[[], Session] = Session) -> DataFrame:
    """key and `found` (JSON text, null for none) and `error` of every distinct key: one session per task asks for all of its keys."""
    kind = dict(keys.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = session()
        for batch in batches:
            found, errors = [], []
            for k in batch.column(0).to_pylist():
                try:
                    out = ask(client, k)
                    found.append(None if out is None else json.dumps(out, sort_keys=True))
                    errors.append(None)
                except ServiceError as e:
                    found.append(None)
                    errors.append(str(e))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string()), pa.array(errors, pa.string())], [key, "found", "error"])

    return keys.select(key).where(F.col(key).isNotNull()).distinct().mapInArrow(run, f"{key} {kind}, found string, error string")


DOWNLOADED = "url string, output_path string, sha256 string, size_bytes bigint, page_count int, resolved_url string, content_type string, error string"


def download(candidates: DataFrame, out: str, session: Callable[[], Session] = Session, least: int = LEAST_PDF, most: int = MOST_PDF) -> DataFrame:
    """One row per row of candidates(url, name): the PDF at url is checked and written as out/<name>, or `error` says why not.

    Files come into place as a whole under a name that the row gives, so a task that runs twice leaves one file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = session()
        fs, root = pyarrow.fs.FileSystem.from_uri(out)
        fs.create_dir(root, recursive=True)
        names = [c.split()[0] for c in DOWNLOADED.split(", ")]
        for batch in batches:
            rows = []
            for url, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    got = fetch_pdf(client, url, None, least, most)
                    temp = f"{root}/.{uuid.uuid4().hex}"
                    with fs.open_output_stream(temp) as sink:
                        sink.write(got.pop("content"))
                    fs.move(temp, f"{root}/{name}")
                    rows.append({"url": url, "output_path": f"{out}/{name}", "error": None} | got)
                except ServiceError as e:
                    rows.append({"url": url, "error": str(e)})
            kinds = {"size_bytes": pa.int64(), "page_count": pa.int32()}
            yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kinds.get(n, pa.string())) for n in names], names)

    return candidates.select("url", "name").mapInArrow(run, DOWNLOADED)


def query_filter(from_year: int | None = None, to_year: int | None = None) -> str:
    """The predicate that a works service is asked with: open articles of a range of years, either end of which may be open."""
    years = {(True, True): f"{from_year}-{to_year}", (True, False): f">{(from_year or 0) - 1}", (False, True): f"<{(to_year or 0) + 1}"}
    asked = years.get((from_year is not None, to_year is not None))
    return ",".join(["type:article", "open_access.is_oa:true"] + ([f"publication_year:{asked}"] if asked else []))


def open_access_locations(found: Column) -> Column:
    """The places of a work in the JSON that open_access_record() answered, the best first."""
    place = "struct<url_for_pdf:string,url:string,license:string,version:string,host_type:string,url_for_landing_page:string>"
    parsed = F.from_json(found, f"best_oa_location {place}, oa_locations array<{place}>")
    best = F.when(parsed["best_oa_location"].isNotNull(), F.array(parsed["best_oa_location"])).otherwise(F.array().cast(f"array<{place}>"))
    return F.array_distinct(F.concat(best, F.coalesce(parsed["oa_locations"], F.array().cast(f"array<{place}>"))))
