"""A polite HTTP client: one request at a time, spaced, retried, within robots.txt."""

from __future__ import annotations

import http.cookiejar
import logging
import random
import time
import urllib.error
import urllib.parse
import urllib.request
import urllib.robotparser
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

log = logging.getLogger(__name__)

#: Statuses that may go away by themselves.
RETRYABLE = frozenset((429, 500, 502, 503, 504))


class RobotsGate:
    """robots.txt of a site; one that cannot be read allows everything."""

    def __init__(self, base_url: str, agent: str, opener: Callable = urllib.request.urlopen):
        self.agent, self.rules = agent, urllib.robotparser.RobotFileParser()
        try:
            with opener(urllib.parse.urljoin(base_url, "/robots.txt"), timeout=10) as r:
                self.rules.parse(r.read().decode("utf-8", "replace").splitlines())
        except (urllib.error.URLError, OSError):
            self.rules.allow_all = True

    def allows(self, url: str) -> bool:
        return self.rules.can_fetch(self.agent, url)

    def delay(self, floor: float) -> float:
        return max(floor, float(self.rules.crawl_delay(self.agent) or 0))


@dataclass
class Throttle:
    """Requests start at least `spacing` seconds after the one before has ended, and up to `jitter` later."""

    spacing: float
    jitter: float = 0.0
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    last: float | None = None

    def wait(self) -> None:
        left = 0.0 if self.last is None else self.spacing - (self.clock() - self.last)
        if left > 0:
            self.sleep(left + random.uniform(0, self.jitter))

    def done(self) -> None:
        self.last = self.clock()


def answered(request, timeout: float, retries: int, backoff: float, opener: Callable, sleep: Callable[[float], None], throttle: Throttle | None = None) -> Any | None:
    """The open response, or None when all attempts fail or the status is final; waits backoff, twice that, ... between them."""
    for attempt in range(retries):
        if throttle:
            throttle.wait()
        try:
            return opener(request, timeout=timeout)
        except urllib.error.HTTPError as e:
            log.warning("status %d, attempt %d", e.code, attempt + 1)
            if e.code not in RETRYABLE:
                return None
        except (urllib.error.URLError, TimeoutError, OSError) as e:
            log.warning("%s, attempt %d", e, attempt + 1)
        finally:
            if throttle:
                throttle.done()
        if attempt + 1 < retries:
            sleep(backoff * 2**attempt)
    return None


def whole(response) -> bytes | None:
    if response is None:
        return None
    try:
        with response:
            return response.read()
    except OSError as e:
        log.error("the body broke off: %s", e)
        return None


def fetch(request, timeout: float, retries: int, backoff: float, opener: Callable = urllib.request.urlopen, sleep: Callable[[float], None] = time.sleep) -> bytes | None:
    """One body without a client; None when all attempts fail."""
    return whole(answered(request, timeout, retries, backoff, opener, sleep))


@dataclass
class Client:
    """All requests of a run to one site. A site that is down is None to the caller, never an exception."""

    base_url: str
    agent: str = "corpusloom"
    spacing: float = 3.0
    jitter: float = 1.5
    timeout: float = 35.0
    retries: int = 5
    backoff: float = 2.0
    opener: Callable | None = None
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    cookies: http.cookiejar.CookieJar = field(default_factory=http.cookiejar.CookieJar)

    def __post_init__(self) -> None:
        if self.opener is None:
            self.opener = urllib.request.build_opener(urllib.request.HTTPCookieProcessor(self.cookies)).open
        self.robots = RobotsGate(self.base_url, self.agent, self.opener)
        self.throttle = Throttle(self.robots.delay(self.spacing), self.jitter, self.clock, self.sleep)

    def warm_up(self) -> bool:
        """One GET of the site before the first form is sent, so that the session's cookie is there; whether it was answered."""
        response = self.open(self.base_url)
        if response is None:
            return False
        response.close()
        return True

    def open(self, url: str, form: dict | None = None, headers: dict | None = None) -> Any | None:
        """The open response, or None: disallowed, or failed for good."""
        if not self.robots.allows(url):
            log.error("robots.txt disallows %s", url)
            return None
        data = None if form is None else urllib.parse.urlencode(form).encode()
        given = {"User-Agent": self.agent, **({"Referer": self.base_url} if form is not None else {}), **(headers or {})}
        return answered(urllib.request.Request(url, data=data, headers=given), self.timeout, self.retries, self.backoff, self.opener, self.sleep, self.throttle)

    def read(self, url: str, form: dict | None = None) -> bytes | None:
        """The whole body, or None."""
        return whole(self.open(url, form))
