"""Pages from a cursor-paged HTTP interface, as a stream: `spark.readStream.format("cursor_pages")`.

The stream's offset is the cursor, so a restarted query goes on where its checkpoint ends. Every page names the next; the
reader asks for it as soon as it knows the cursor, while the page is handed on. The interface is serial by nature.
"""

from __future__ import annotations

import http.client
import json
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from citelake.functions.text import with_parameters
from citelake.sources.zip_pages import member_name

RETRIED = frozenset({500, 502, 503, 504})  # fixed values: responses worth another try


class _FewRedirects(urllib.request.HTTPRedirectHandler):
    max_redirections = 5


def pause_before(attempt: int, factor: float, longest: float) -> float:
    """Seconds to wait before another attempt: none before the first, then doubling from twice the factor, up to `longest`."""
    return 0.0 if attempt <= 1 else min(longest, factor * 2 ** (attempt - 1))


def fetch(url: str, retries: int = 10, factor: float = 1.0, longest: float = 120.0, timeout: float = 60.0) -> bytes:
    """The body at a URL; server errors, broken connections and truncated bodies are tried again with growing pauses. At most 5 redirects."""
    opener = urllib.request.build_opener(_FewRedirects)
    for attempt in range(retries + 1):
        time.sleep(pause_before(attempt, factor, longest))
        try:
            with opener.open(url, timeout=timeout) as response:
                return response.read()
        except urllib.error.HTTPError as e:
            if e.code not in RETRIED or attempt == retries:
                raise
        except (urllib.error.URLError, http.client.HTTPException, ConnectionError, TimeoutError):
            if attempt == retries:
                raise
    raise AssertionError


class CursorPagesReader(SimpleDataSourceStreamReader):
    """Reads up to `pagesPerBatch` pages a batch; the offset is `{cursor, page, offset, rows, done}`."""

    def __init__(self, options: dict):
        self.url = options["url"]
        self.rows = int(options.get("rows", 1000))
        self.pages = int(options.get("pagesPerBatch", options.get("pagesperbatch", 10)))
        self.retries = int(options.get("maxretries", options.get("maxRetries", 10)))
        self.factor = float(options.get("pausefactor", options.get("pauseFactor", 1.0)))
        self.stem = options.get("stem", "works")
        self.email = options.get("email")

    def initialOffset(self) -> dict:
        return {"cursor": "*", "page": 0, "offset": 0, "rows": self.rows, "done": False}

    def page_url(self, cursor: str) -> str:
        return with_parameters(self.url, {"rows": self.rows, "cursor": cursor} | ({"mailto": self.email} if self.email else {}))

    def _walk(self, start: dict, most: int) -> Iterator[tuple[tuple[str, str], dict]]:
        if start["rows"] != self.rows:
            raise ValueError(f"the checkpoint was written with {start['rows']} rows a page, not {self.rows}")
        at = dict(start)
        with ThreadPoolExecutor(1) as pool:
            ahead = None if at["done"] else pool.submit(fetch, self.page_url(at["cursor"]), self.retries, self.factor)
            for n in range(most):
                if at["done"]:
                    return
                content = ahead.result().decode("utf-8")
                message = json.loads(content).get("message", {})
                following = message.get("next-cursor")
                member = member_name(self.stem, at["page"], at["offset"])
                # The last page is one that names no next cursor, its own cursor, or brings nothing.
                done = not following or following == at["cursor"] or not message.get("items")
                at = {"cursor": at["cursor"] if done else following, "page": at["page"] + 1, "offset": at["offset"] + self.rows, "rows": self.rows, "done": done}
                if not done and n + 1 < most:
                    ahead = pool.submit(fetch, self.page_url(following), self.retries, self.factor)
                yield (member, content), at

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        walked = list(self._walk(start, self.pages))
        return iter([page for page, _ in walked]), (walked[-1][1] if walked else start)

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter([page for page, _ in self._walk(start, end["page"] - start["page"])])


class CursorPages(DataSource):
    """Options: url, rows (a page, 1000), pagesPerBatch (10), maxRetries (10), pauseFactor (1), stem, email."""

    @classmethod
    def name(cls) -> str:
        return "cursor_pages"

    def schema(self) -> str:
        return "member string, content string"

    def simpleStreamReader(self, schema) -> CursorPagesReader:
        return CursorPagesReader(dict(self.options))
