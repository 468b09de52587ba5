"""A REST ticket system as a Spark data source, and its client.

``spark.read.format("tickets")`` with the options url, module, key, page_size, limit, max_retries and
wait gives (module, page, position, id, record): one record a row as JSON. The first page tells the
total, and each partition fetches a range of pages. ``spark.readStream`` of it goes on where it stopped.
"""

from __future__ import annotations

import http.client
import json
import os
import ssl
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from tidemark.runtime import ship

# Page cap, statuses worth another try, the throttle's code, its first and longest wait and tries.
PAGE_CAP = 100
RETRIED = (429, 500, 502, 503, 504)
THROTTLED, THROTTLE_WAIT, THROTTLE_MOST, THROTTLE_TRIES = 4001, 30, 300, 8
# Modules, whether their records have details, and their sub-resources.
MODULES = {
    "requests": (True, ("notes",)),
    "problems": (True, ("notes",)),
    "changes": (True, ("notes",)),
    "projects": (True, ()),
    "solutions": (True, ()),
    "users": (False, ()),
    "technicians": (False, ()),
    "support_groups": (False, ()),
    "categories": (False, ()),
    "sites": (False, ()),
}


def parse_modules(text: str) -> list[str]:
    """``all`` or a comma list; ValueError names what is unknown."""
    if text.strip() == "all":
        return list(MODULES)
    names = [m.strip() for m in text.split(",") if m.strip()]
    if bad := [m for m in names if m not in MODULES]:
        raise ValueError(f"unknown modules: {', '.join(bad)}")
    return names


def base_url(url: str) -> str:
    """Without slashes at the end or the API's path, in whatever case."""
    url = url.strip().rstrip("/")
    return (url[:-7] if url.lower().endswith("/api/v3") else url).rstrip("/")


def dotenv(text: str) -> dict[str, str]:
    """NAME=value lines of a settings file; comments, ``export`` and quotes around values are left out."""
    out = {}
    for line in text.splitlines():
        name, eq, value = line.strip().removeprefix("export ").partition("=")
        if eq and not name.strip().startswith("#"):
            value = value.strip()
            quoted = len(value) > 1 and value[0] == value[-1] and value[0] in "\"'"
            out[name.strip()] = value[1:-1] if quoted else value.partition(" #")[0].strip()
    return out


# What counts as true in a variable.
TRUE = ("1", "true", "yes", "y", "on")


@dataclass(frozen=True)
class Settings:
    url: str
    key: str = ""
    page_size: int = PAGE_CAP
    max_retries: int = 4
    wait: float = 0.0
    verify: bool = True
    timeout: int = 60

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None, prefix: str = "TICKETS_", file: str | None = None) -> Settings:
        """From variables, which win over those of a settings file; numbers must be numbers, and pages are capped."""
        known = dotenv(Path(file).read_text(encoding="utf-8")) if file and Path(file).exists() else {}
        env = known | dict(os.environ if env is None else env)
        get = lambda k, d: env.get(prefix + k, "").strip() or str(d)
        got = cls(base_url(get("URL", "")), get("KEY", ""), min(PAGE_CAP, max(1, int(get("PAGE_SIZE", PAGE_CAP)))), int(get("MAX_RETRIES", 4)), float(get("WAIT", 0)), get("VERIFY", "true").lower() in TRUE, int(get("TIMEOUT", 60)))
        if not got.url:
            raise ValueError(f"{prefix}URL must be set")
        return got

    def connected(self) -> Settings:
        """Itself, if there is all that a connection needs."""
        if missing := [k for k in ("url", "key") if not getattr(self, k)]:
            raise ValueError(f"not set: {', '.join(missing)}")
        return self


class RequestFailed(RuntimeError):
    pass


def backoff(attempt: int, retry_after: str | None = None) -> float:
    """Seconds before try ``attempt`` is repeated, counted from 1: what the server says, if that is a number above 0, else 2, 4
    and so on up to 30."""
    try:
        said = float(retry_after or 0)
    except ValueError:
        said = 0.0
    return said if 0 < said < float("inf") else float(min(2**attempt, 30))


def throttle_wait(times: int) -> float:
    return float(min(THROTTLE_WAIT * 2 ** (times - 1), THROTTLE_MOST))


def is_throttle(status: int, body: str) -> bool:
    """HTTP 400 with the application's own code for too many requests."""
    if status != 400:
        return False
    try:
        said = json.loads(body).get("response_status") or {}
    except (ValueError, AttributeError):
        return False
    parts = said if isinstance(said, list) else [said]
    codes = [m.get("status_code") for p in parts if isinstance(p, dict) for m in [p, *(p.get("messages") or [])] if isinstance(m, dict)]
    return THROTTLED in codes or str(THROTTLED) in codes


class Client:
    """Reads with tries that are bounded and waits that grow. ``sleep`` can be replaced in tests."""

    def __init__(self, settings: Settings, sleep: Callable[[float], None] = time.sleep):
        self.settings, self.sleep = settings, sleep
        self._tls = None if settings.verify else ssl._create_unverified_context()

    def get(self, path: str, params: dict | None = None) -> dict:
        url = f"{self.settings.url}/api/v3/{path}" + (f"?{urllib.parse.urlencode(params)}" if params else "")
        attempt = throttled = 0
        while True:
            try:
                request = urllib.request.Request(url, headers={"authtoken": self.settings.key, "Accept": "application/json"})
                with urllib.request.urlopen(request, timeout=self.settings.timeout, context=self._tls) as r:
                    got = json.loads(r.read().decode("utf-8"))
                if not isinstance(got, dict):
                    raise ValueError("not a JSON object")
                if self.settings.wait:
                    self.sleep(self.settings.wait)
                return got
            except urllib.error.HTTPError as e:
                body = e.read().decode("utf-8", "replace")
                if is_throttle(e.code, body):
                    throttled += 1
                    if throttled > THROTTLE_TRIES:
                        raise RequestFailed(f"throttled {throttled} times at {path}") from e
                    self.sleep(throttle_wait(throttled))
                    continue
                if e.code not in RETRIED or attempt >= self.settings.max_retries:
                    raise RequestFailed(f"HTTP {e.code} at {path}") from e
                said = e.headers.get("Retry-After")
            # a body that is cut short or is no JSON is no answer either
            except (urllib.error.URLError, http.client.HTTPException, TimeoutError, ConnectionError, ValueError) as e:
                if attempt >= self.settings.max_retries:
                    raise RequestFailed(f"no answer at {path}: {e}") from e
                said = None
            attempt += 1
            self.sleep(backoff(attempt, said))

    def page(self, module: str, start: int, count: int) -> dict:
        info = {"list_info": {"row_count": count, "start_index": start, "get_total_count": True}}
        return self.get(module, {"input_data": json.dumps(info)})

    def pages(self, module: str, limit: int | None = None) -> Iterator[dict]:
        """Pages in order; the next starts where the server says this one started, and its rows."""
        start, had = 1, 0
        while limit is None or had < limit:
            size = self.settings.page_size if limit is None else min(self.settings.page_size, limit - had)
            got = self.page(module, start, size)
            rows = records(got, module)
            yield got
            had += len(rows)
            info = got.get("list_info") or {}
            if not rows or not info.get("has_more_rows"):
                return
            start = int(info.get("start_index") or start) + len(rows)

    def detail(self, module: str, id: str) -> dict:
        return self.get(f"{module}/{id}")

    def sub_resource(self, module: str, id: str, name: str) -> dict:
        return self.get(f"{module}/{id}/{name}")

    def bundle(self, module: str, id: str, notes: bool = True) -> dict:
        """A record with its sub-resources; one that fails leaves its error in its place."""
        out = {"detail": self.detail(module, id)}
        for name in MODULES[module][1] if notes else ():
            try:
                out[name] = self.sub_resource(module, id, name)
            except RequestFailed as e:
                out[name] = {"_error": str(e)}
        return out


def records(page: dict, module: str) -> list[dict]:
    """The records of a page: the module's own list, else the first list of objects, else none."""
    own = page.get(module)
    if isinstance(own, list):
        return own
    return next((v for v in page.values() if isinstance(v, list) and v and all(isinstance(x, dict) for x in v)), [])


class _Range(InputPartition):
    """Records from ``start`` up to before ``end`` (None: as long as the server has more), counted from 1."""

    def __init__(self, start: int, end: int | None):
        self.start, self.end = start, end


def settings_of(options: dict) -> Settings:
    """The settings that a data source's options say."""
    size, verify = min(PAGE_CAP, int(options.get("page_size", PAGE_CAP))), str(options.get("verify", "true")).lower() in TRUE
    return Settings(base_url(options["url"]), options.get("key", ""), size, int(options.get("max_retries", 4)), float(options.get("wait", 0)), verify, int(options.get("timeout", 60)))


def _as_row(module: str, number: int, size: int, record: dict) -> tuple:
    """A record, counted from 1, as (module, page, position, id, record)."""
    return module, (number - 1) // size, (number - 1) % size, None if record.get("id") is None else str(record["id"]), json.dumps(record, ensure_ascii=False)


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.module, self.settings = options.get("module", "requests"), settings_of(options)
        self.limit = int(options["limit"]) if "limit" in options else None
        self.per_task = int(options.get("pages_per_task", 10))

    def partitions(self):
        """Ranges by the server's total, the last one open; without a total one range, read page by page."""
        info = Client(self.settings).page(self.module, 1, 1).get("list_info") or {}
        end = None if self.limit is None else self.limit + 1
        total = int(info.get("total_count") or 0)
        if not total:
            return [_Range(1, end)]
        total = total if self.limit is None else min(total, self.limit)
        step = self.settings.page_size * self.per_task
        starts = [*range(1, total + 1, step)]
        return [_Range(a, b) for a, b in zip(starts, [*starts[1:], end])]

    def pages(self, partition: _Range) -> Iterator[tuple[int, dict]]:
        """(where it starts, page) of a range; the next starts where the server says this one did, and its rows."""
        client, at, size = Client(self.settings), partition.start, self.settings.page_size
        while partition.end is None or at < partition.end:
            got = client.page(self.module, at, size if partition.end is None else min(size, partition.end - at))
            rows, info = records(got, self.module), got.get("list_info") or {}
            first = int(info.get("start_index") or at)
            if rows:
                yield first, got
            if not rows or first + len(rows) <= at or not info.get("has_more_rows", True):
                return
            at = first + len(rows)

    def read(self, partition):
        at = partition.start
        for first, got in self.pages(partition):
            rows = records(got, self.module)
            for i, r in enumerate(rows, first):
                if at <= i and (partition.end is None or i < partition.end):
                    yield _as_row(self.module, i, self.settings.page_size, r)
            at = first + len(rows)


class _News(SimpleDataSourceStreamReader):
    """Records in the order of the server's list, from where the last run stopped: for lists that grow at their end.

    An offset is the place of the next record. What lies between two offsets is fetched again if a run is repeated.
    """

    def __init__(self, options: dict):
        self.reader, self.start = _Reader(options), int(options.get("start", 1))

    def initialOffset(self) -> dict:
        return {"start": self.start}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, at = [], start["start"]
        for first, got in self.reader.pages(_Range(at, None)):
            new = [(i, r) for i, r in enumerate(records(got, self.reader.module), first) if i >= at]
            rows += [_as_row(self.reader.module, i, self.reader.settings.page_size, r) for i, r in new]
            at = new[-1][0] + 1 if new else at
        return iter(rows), {"start": at}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return self.reader.read(_Range(start["start"], end["start"]))


class TicketSource(DataSource):
    @classmethod
    def name(cls):
        return "tickets"

    def schema(self):
        return "module string, page int, position int, id string, record string"

    def reader(self, schema):
        return _Reader(self.options)

    def simpleStreamReader(self, schema):
        return _News(self.options)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(TicketSource)
