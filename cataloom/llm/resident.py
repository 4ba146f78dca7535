"""One table of remembered words in a worker process at a time.

Python workers are reused by later stages.  Each operator remembers what it worked out for words met
before; when another operator runs in the same process, the former's table is dropped, so the memory
of a worker is that of its largest table and never their sum.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

_HELD: dict[Any, Any] = {}


def resident(key: Any, make: Callable[[], Any]) -> Any:
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]
