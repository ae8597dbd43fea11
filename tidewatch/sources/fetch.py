"""Fetching a feed to a landing file on the driver; parsing is Spark's."""

from __future__ import annotations

import os
import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable


class FetchFailed(RuntimeError):
    pass


def _get(url: str, timeout: float) -> bytes:
    with urllib.request.urlopen(url, timeout=timeout) as r:  # noqa: S310 - the caller names the feed
        return r.read()


def fetch(url: str, to: str, attempts: int = 4, timeout: float = 90, longest: float = 20, get: Callable[[str, float], bytes] = _get, sleep: Callable[[float], None] = time.sleep) -> str:
    """Write the feed's body to ``to``. Time-outs, network errors and server errors are tried again after a growing, jittered pause; client errors aren't."""
    for attempt in range(1, attempts + 1):
        try:
            body = get(url, timeout)
            break
        except urllib.error.HTTPError as e:
            if e.code < 500 or attempt == attempts:
                raise FetchFailed(f"{url}: {e.code}") from e
        except (TimeoutError, OSError) as e:
            if attempt == attempts:
                raise FetchFailed(f"{url}: {e}") from e
        sleep(min(longest, random.uniform(1, 2**attempt)))
    tmp = f"{to}.tmp"
    with open(tmp, "wb") as f:
        f.write(body)
    os.replace(tmp, to)
    return to
