"""The search engines we recognise in referrer URLs.

Fixed values: these must equal the engines and query parameters the
attribution report is defined over. Engine domain -> name of the query
parameter that carries the keyword.

    google.com      q
    google.co.uk    q
    google.ca       q
    bing.com        q
    msn.com         q
    yahoo.com       p
    search.yahoo.com p
    ask.com         q
    aol.com         q
    duckduckgo.com  q

Matching is "host equals the engine, or ends with '.' + engine", tried in
the order above, so ``search.yahoo.com`` is always claimed by ``yahoo.com``
first and never reported as itself.
"""

from __future__ import annotations

# Fixed values (engine domain, keyword parameter), in matching order.
ENGINE_PARAMS: tuple[tuple[str, str], ...] = (
    ("google.com", "q"),
    ("google.co.uk", "q"),
    ("google.ca", "q"),
    ("bing.com", "q"),
    ("msn.com", "q"),
    ("yahoo.com", "p"),
    ("search.yahoo.com", "p"),
    ("ask.com", "q"),
    ("aol.com", "q"),
    ("duckduckgo.com", "q"),
)


def effective_engines(
    engines: tuple[tuple[str, str], ...] = ENGINE_PARAMS,
) -> tuple[tuple[str, str], ...]:
    """Drop engines that an earlier entry always claims (suffix shadowing)."""
    kept: list[tuple[str, str]] = []
    for domain, param in engines:
        shadowed = any(domain == d or domain.endswith("." + d) for d, _ in kept)
        if not shadowed:
            kept.append((domain, param))
    return tuple(kept)


def params_by_engine(
    engines: tuple[tuple[str, str], ...] = ENGINE_PARAMS,
) -> dict[str, list[str]]:
    """Query parameter name -> engine domains that use it (effective only)."""
    out: dict[str, list[str]] = {}
    for domain, param in effective_engines(engines):
        out.setdefault(param, []).append(domain)
    return out
