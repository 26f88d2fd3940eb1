"""Feeds and APIs as a Python data source: a partition per feed or per query, retries inside the reader, bodies out.

A transport turns a URL into (status, body, seconds to wait). `file` reads bodies that were stored under their URL's hash, on any file system that
tasks share, so everything downstream runs without a network; `http` uses the standard library.

Filters on `name` and lower bounds on `newest` are pushed into a batch scan: names that aren't asked for have no partition, and a scan sorted by date ends
with the page on which what is older than the bound begins. As a stream, an API with a cursor goes on behind what it has read, and a feed is asked once a
trigger.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable, Iterator, Sequence
from datetime import UTC, date, datetime
from email.utils import parsedate_to_datetime
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition

from ..operators.policy import SharedPause
from ..sinks.shared import opened, write_whole

Transport = Callable[[str], tuple[int, str, float | None]]

#: newest: the latest date that a page can hold; of a page that states none, or couldn't be read, the day on which it was asked for.
BODY = "name string, url string, page int, status int, body string, error string, newest date"
#: Characters of pages in a batch of a reader, but for its last page.
BATCH = 4 << 20
_ARROW = pa.schema([("name", pa.string()), ("url", pa.string()), ("page", pa.int32()), ("status", pa.int32()), ("body", pa.string()), ("error", pa.string()), ("newest", pa.date32())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


def stored_name(url: str) -> str:
    return hashlib.sha256(url.encode()).hexdigest()[:32]


def file_transport(folder: str) -> Transport:
    """Bodies that `sinks.files.stored` kept, from a folder on any file system; nobody is asked for them."""
    at: list = []  # opened once a task

    def get(url: str) -> tuple[int, str, float | None]:
        if not at:
            at.extend(opened(folder))
        fs, path = at
        try:
            with fs.open_input_stream(f"{path}/{stored_name(url)}") as f:
                return 200, f.read().decode(), None
        except FileNotFoundError:
            return 404, "", None

    get.local = True
    return get


def http_transport(timeout: float = 30.0, agent: str = "folioscope") -> Transport:
    """Requests of one reader share their cookies, which pages behind a gate set on the first visit."""
    opener = urllib.request.build_opener(urllib.request.HTTPCookieProcessor())

    def get(url: str) -> tuple[int, str, float | None]:
        request = urllib.request.Request(url, headers={"User-Agent": agent})
        try:
            with opener.open(request, timeout=timeout) as r:  # the caller names the URLs
                return r.status, r.read().decode("utf-8", "replace"), None
        except urllib.error.HTTPError as e:
            return e.code, "", retry_after(e.headers.get("Retry-After"))

    return get


def retry_after(header: str | None, now: Callable[[], float] = time.time) -> float | None:
    """Seconds that a server asks to wait, stated as a number or as a date; none if it states neither, or no time that is still to come."""
    told = (header or "").strip()
    try:
        wait = float(told) if told.isdigit() else parsedate_to_datetime(told).timestamp() - now()
    except (TypeError, ValueError):
        return None
    return wait if wait > 0 else None


def paced(get: Transport, interval: float, pause: SharedPause | None = None, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> Transport:
    """A transport that leaves the interval between two requests, retries too. A pause that a busy server asks for is kept by all tasks that share `pause`."""
    state = {"next": float("-inf")}  # no time of this machine's clock goes to another

    def polite(url: str) -> tuple[int, str, float | None]:
        left = max(state["next"] - clock(), pause.wait() if pause else 0.0)
        if left > 0:
            sleep(left)
        state["next"] = clock() + interval
        status, body, wait = get(url)
        if pause and wait and status in (408, 429, 503):
            pause.extend(wait)
        return status, body, wait

    return polite


def backoff(attempt: int, most: float = 20.0, first: float = 3.0) -> float:
    """Seconds before the next attempt: 3, 6, 12, ... up to a limit."""
    return min(first * 2 ** (attempt - 1), most)


def fetch(get: Transport, url: str, retries: int = 3, most_wait: float = 20.0, sleep: Callable[[float], None] = time.sleep) -> tuple[int, str, str | None]:
    """Status, body and error. Busy servers and failures are asked again after a pause; a client's error is final."""
    error = None
    for attempt in range(1, retries + 1):
        wait = None
        try:
            status, body, wait = get(url)
            if status == 200:
                return status, body, None
            error = f"HTTP {status}"
            if 400 <= status < 500 and status not in (408, 429):
                return status, "", error
        except OSError as e:
            status, error = 0, str(e)
        if attempt < retries:
            sleep(min(wait, most_wait) if wait is not None else backoff(attempt, most_wait))
    return status, "", error


class _One(InputPartition):
    def __init__(self, name: str, url: str, cursor: int = 0, until: int | None = None, body: str | None = None) -> None:
        self.name, self.url, self.cursor, self.until, self.body = name, url, cursor, until, body


class _Lane(InputPartition):
    """Requests of one service that a task makes one after the other."""

    def __init__(self, requests: list[_One]) -> None:
        self.requests = requests


def lanes(requests: Sequence[_One], interval: float) -> list[InputPartition]:
    """A partition for each request; if an interval is to be kept, one for each host, as no two tasks can keep it together."""
    if interval <= 0:
        return list(requests)
    by_host: dict[str, list[_One]] = {}
    for one in requests:
        by_host.setdefault(urlsplit(one.url).netloc.lower(), []).append(one)
    return [_Lane(held) for held in by_host.values()]


def _interval(options: dict) -> float:
    return float(options.get("interval", 0))


def _transport(options: dict) -> Transport:
    folder, pause = options.get("folder"), options.get("pause")
    get = file_transport(folder) if folder else http_transport(float(options.get("timeout", 30)))
    return paced(get, _interval(options), SharedPause(pause) if pause else None) if pause or _interval(options) > 0 else get


def _requests(options: dict) -> list[dict]:
    return json.loads(options["requests"])


#: Where feeds and APIs state the date of an entry.
_DATED = re.compile(r'<(?:published|updated|pubDate|dc:date|prism:publicationDate)[^>]*>\s*(\d{4}-\d{2}-\d{2})|"date"\s*:\s*"(\d{4}-\d{2}-\d{2})"')


def stated_dates(body: str) -> list[date]:
    found = []
    for m in _DATED.finditer(body):
        try:
            found.append(date.fromisoformat(m[1] or m[2]))
        except ValueError:
            pass
    return found


class WebReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = {k.lower(): v for k, v in dict(options).items()}
        self.names: set[str] | None = None
        self.least: date | None = None

    def partitions(self) -> list[InputPartition]:
        return lanes([_One(x["name"], x["url"]) for x in _requests(self.options) if self.names is None or x["name"] in self.names], _interval(self.options))

    def read(self, partition: _One | _Lane) -> Iterator[pa.RecordBatch]:
        """The rows of `rows` in batches of some megabytes, where Spark would gather 10,000 pages of whatever size."""
        held, size = [], 0
        for row in self.rows(partition):
            held.append(row)
            size += len(row[4] or "")
            if size >= BATCH:
                yield _batch(held)
                held, size = [], 0
        if held:
            yield _batch(held)

    def rows(self, partition: _One | _Lane) -> Iterator[tuple]:
        """One page, or pages until one is empty, holds the last of the `total` that pages state, or reaches what is older than a bound on `newest` (with
        the option `sorted`: a scan sorted by date has nothing newer after that). {page} in the URL is the page, {cursor} the offset, which grows by the
        `count` that a page states, else by the page size. A scan that ends sooner, as the time is up or `pages` are read, ends in a row whose error says
        that it is incomplete. `interval`: seconds between two requests to a host; `pause`: a shared folder in which tasks tell each other of a host's pause."""
        get = _transport(self.options)
        for one in partition.requests if isinstance(partition, _Lane) else [partition]:
            for row, oldest in self._pages(one, get):
                if self.least is None or row[-1] >= self.least:
                    yield row
                if self.least is not None and oldest is not None and oldest < self.least and self.options.get("sorted", "true") == "true":
                    break

    def _pages(self, partition: _One, get: Transport) -> Iterator[tuple[tuple, date | None]]:
        retries = int(self.options.get("retries", 3))
        pages, size = int(self.options.get("pages", 1)), int(self.options.get("pagesize", 100))
        until = time.monotonic() + float(self.options.get("seconds", 120))
        today = datetime.now(UTC).date()
        cursor = partition.cursor
        for page in range(pages):
            url = partition.url.replace("{page}", str(page)).replace("{cursor}", str(cursor))
            status, body, error = (200, partition.body, None) if partition.body is not None and not page else fetch(get, url, retries)
            stated = stated_dates(body)
            yield (partition.name, url, page, status, body, error, max(stated, default=today)), min(stated, default=None)
            if error or not body.strip() or "{" not in partition.url:
                return
            count, total = _stated("count", body), _stated("total", body)
            cursor += size if count is None else count
            if partition.until is not None and cursor >= partition.until or total is not None and cursor >= total:
                return
            if count == 0 or time.monotonic() > until:
                why = "an empty page" if count == 0 else "no time left"
                break
        else:
            why = f"{pages} pages read"
        if pages > 1:
            yield (partition.name, partition.url, page + 1, 0, "", f"incomplete: {why}", today), None


class PushedReader(WebReader):
    """For sessions that let filters be pushed into Python sources; others refuse a reader that has the method."""

    def pushFilters(self, filters: Sequence[Filter]) -> Iterable[Filter]:  # noqa: N802 - the interface's name
        """Takes filters on names and lower bounds on the date; the others are Spark's, as is a bound that isn't a date."""
        for f in filters:
            column = getattr(f, "attribute", None)
            if column == ("name",) and isinstance(f, EqualTo | In):
                names = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.names = names if self.names is None else self.names & names
            elif column == ("newest",) and isinstance(f, GreaterThanOrEqual | GreaterThan) and isinstance(f.value, date):
                least = f.value if isinstance(f, GreaterThanOrEqual) else date.fromordinal(f.value.toordinal() + 1)
                self.least = least if self.least is None else max(self.least, least)
            else:
                yield f


class WebStreamReader(DataSourceStreamReader):
    """A stream of pages. The offset of an API with a cursor is how many of its records were read; one page of each is asked for to learn how many there
    are, and is not asked for again. The offset of a feed without a cursor is the time of asking: each trigger asks it once.

    What was read is kept in `offsets`, a file in a shared folder, as Spark tells a source that starts again nothing before it has to know.
    """

    def __init__(self, options: dict) -> None:
        self.options = {k.lower(): v for k, v in dict(options).items()}
        self.asked = {x["name"]: x["url"] for x in _requests(self.options)}
        self.probed: dict[str, tuple[int, str]] = {}
        self.known = self._kept()

    def _kept(self) -> dict:
        if path := self.options.get("offsets"):
            fs, at = opened(path)
            try:
                with fs.open_input_stream(at) as f:
                    return json.loads(f.read())
            except FileNotFoundError:
                pass
        return {}

    def initialOffset(self) -> dict:  # noqa: N802
        return dict.fromkeys(self.asked, 0)

    def latestOffset(self) -> dict:  # noqa: N802
        get, retries = _transport(self.options), int(self.options.get("retries", 3))
        found = {}
        for name, url in self.asked.items():
            at = int(self.known.get(name, 0))
            if "{cursor}" not in url:
                found[name] = max(at + 1, time.time_ns() // 1_000_000)
                continue
            if name not in self.probed or self.probed[name][0] != at:
                status, body, error = fetch(get, url.replace("{cursor}", str(at)), retries)
                total = None if error else _stated("total", body)
                # a page that can't be read, or states no total, is no news
                if total is None or total <= at:
                    found[name] = at
                    continue
                self.probed[name] = at, body
            found[name] = max(at, _stated("total", self.probed[name][1]) or 0)
        return found

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out = []
        for name, url in self.asked.items():
            a, b = int(start.get(name, 0)), int(end.get(name, 0))
            self.known[name] = max(int(self.known.get(name, 0)), a)
            if b <= a:
                continue
            if "{cursor}" not in url:
                out.append(_One(name, url))
            else:
                at, body = self.probed.get(name, (None, None))
                out.append(_One(name, url, a, b, body if at == a else None))
        return lanes(out, _interval(self.options))

    def read(self, partition: _One | _Lane) -> Iterator[pa.RecordBatch]:
        return WebReader({"pages": str(1 << 30), **self.options}).read(partition)

    def commit(self, end: dict) -> None:
        self.known = {name: int(n) for name, n in end.items()}
        self.probed = {}
        if path := self.options.get("offsets"):
            write_whole(path, [json.dumps(self.known).encode()])


def _stated(name: str, body: str) -> int | None:
    found = re.search(rf'"{name}"\s*:\s*"?(\d+)', body)
    return int(found[1]) if found else None


class WebSource(DataSource):
    """spark.dataSource.register(WebSource); spark.read.format("web").options(requests=json, folder=...)."""

    @classmethod
    def name(cls) -> str:
        return "web"

    def schema(self) -> str:
        return BODY

    def reader(self, schema):
        own = {k.lower(): v for k, v in dict(self.options).items()}
        return PushedReader(own) if own.get("pushed") == "true" else WebReader(own)

    def streamReader(self, schema):  # noqa: N802
        return WebStreamReader(self.options)


def scan(spark: SparkSession, requests: Iterable[tuple[str, str]], **options: object) -> DataFrame:
    """BODY rows of (name, URL) requests, with filters pushed into the scan."""
    return _reader(spark, spark.read, requests, {"pushed": "true", **options}).load()


def stream(spark: SparkSession, requests: Iterable[tuple[str, str]], **options: object) -> DataFrame:
    """The same as a stream."""
    return _reader(spark, spark.readStream, requests, options).load()


def _reader(spark: SparkSession, reader, requests: Iterable[tuple[str, str]], options: dict):
    spark.dataSource.register(WebSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return reader.format("web").options(requests=json.dumps([{"name": n, "url": u} for n, u in requests]), **{k: str(v) for k, v in options.items()})


def biorxiv_url(start: str, end: str, collection: str, cursor: int | str = "{cursor}") -> str:
    return f"https://api.biorxiv.org/details/biorxiv/{start}/{end}/{cursor}/json?category={quote(collection, safe='')}"


def europepmc_url(issn: str, start: str, end: str) -> str:
    query = quote(f"ISSN:{issn} AND FIRST_PDATE:[{start} TO {end}]", safe="")
    return f"https://www.ebi.ac.uk/europepmc/webservices/rest/search?query={query}&format=json&pageSize=1000&resultType=core"


def first_complete(*sources: DataFrame, complete: Callable[[DataFrame], bool] = lambda df: not df.isEmpty()) -> DataFrame:
    """The first source that is complete, by default one that has rows: a cascade from an API to its stand-ins. Raises if none is, as what is left of one isn't a result."""
    for df in sources:
        if complete(df):
            return df
    raise ValueError(f"none of {len(sources)} sources is complete")


def whole(pages: DataFrame, names: Iterable[str] = ()) -> bool:
    """Whether every scan of a `web` frame came to its end, and told something of each of the names."""
    if not pages.where("error IS NOT NULL").isEmpty():
        return False
    return not (left := set(names)) or left <= {r["name"] for r in pages.where("body RLIKE '\\\\S'").select("name").distinct().collect()}


def required(pages: DataFrame) -> DataFrame:
    """Pages of scans that have to come to their end: a row with an error fails the query when it is read."""
    why = F.concat(F.lit("a scan isn't complete: "), F.concat_ws(" ", "name", "url", "error"))
    return pages.withColumn("body", F.when(F.col("error").isNull(), F.col("body")).otherwise(F.raise_error(why).cast("string")))
