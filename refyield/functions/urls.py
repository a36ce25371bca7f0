"""Referrer URL parsing as native Spark column expressions.

Every function here takes and returns a ``Column``; nothing runs in a
Python worker. The rules follow the standard-library URL split and query
string parse that define "search engine" and "keyword" for the report:

* clean: leading blanks and C0 control characters are dropped, and tab,
  CR and LF are removed anywhere;
* netloc: the text after ``scheme://`` (or a leading ``//``) up to the
  first ``/``, ``?`` or ``#``; it keeps any user and port; there is none where
  it holds a character whose compatibility form (NFKC) has one of ``/?#@:``;
* host: the netloc lower-cased with any leading run of ``w`` and ``.``
  characters removed (``strict=True`` removes exactly one ``www.``);
* engine: the host equals an engine domain or ends with ``.`` + domain;
  hosts holding ``[`` or ``]`` never match;
* query: between the first ``?`` and the first ``#``; parameters are split
  on ``&`` only, pairs without ``=`` or with an empty value are skipped,
  names and values are ``+``-to-space and percent decoded (malformed
  escapes stay literal, bad UTF-8 becomes U+FFFD as in the standard decoder) and names compare
  case-sensitively; the first remaining value wins.

All functions return NULL, never raise, for NULL, blank or malformed input.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from refyield.functions._memo import memo_columns
from refyield.functions.engines import ENGINE_PARAMS, effective_engines, params_by_engine

# The characters beyond ASCII whose compatibility form holds one of
# / ? # @ : (a netloc with one of them is no netloc).
#   2047 2048 2049  double question and exclamation marks
#   2100 2101 2105 2106  account of, addressed to, care of, cada una
#   2A74  double colon equal
#   FE13 FE16 FE55 FE56 FE5F FE6B  vertical and small forms
#   FF03 FF0F FF1A FF1F FF20  fullwidth forms
_SPLITTERS = "\u2047\u2048\u2049\u2100\u2101\u2105\u2106\u2a74\ufe13\ufe16\ufe55\ufe56\ufe5f\ufe6b\uff03\uff0f\uff1a\uff1f\uff20"

_C0_OR_SPACE = "".join(chr(i) for i in range(0x21))
# Empty when the netloc holds a character that would split it once normalised.
_NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#" + _SPLITTERS + "]*)(?![^/?#])"
# The same for brackets too (those never name an engine).
_PLAIN_NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#\[\]" + _SPLITTERS + "]*)(?![^/?#])"
_QUERY = r"^[^#?]*\?([^#]*)"
_PAIR_NAME = r"^([^=]*)="
_PAIR_VALUE = r"(?s)^[^=]*=(.*)\z"
_BAD_ESCAPE = r"%(?![0-9A-Fa-f]{2})"
# The first byte of an encoded surrogate, whole or cut short.
_SURROGATE_LEAD = "%[Ee][Dd](?=%[ABab][0-9A-Fa-f])"
_REPLACEMENT = "%EF%BF%BD"
_LOOSE_PREFIX = r"^[w.]+"
_STRICT_PREFIX = r"^www\."


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def engine_pattern(engines: tuple[tuple[str, str], ...] = ENGINE_PARAMS, *, strict: bool = False) -> str:
    r"""Regexp finding the engine at the end of a lower-cased, bracket-free host.

    ``(?:^[w.]*|\.)(engine)\z``: the engine is the whole host, or follows a
    dot, or follows the leading run of ``w``/``.`` that the loose rule strips
    (exact because no engine starts with ``w`` or ``.``). It has no nested
    quantifiers, so matching is linear in the host length. A CASE per engine
    would repeat the host expression once per branch after inlining.
    """
    alternation = "|".join(re.escape(d) for d, _ in effective_engines(engines))
    lead = "^" if strict or not _can_fold(engines) else "^[w.]*"
    return "(?:" + lead + r"|\.)(" + alternation + r")\z"


def _can_fold(engines) -> bool:
    return not any(d[:1] in ("w", ".") for d, _ in effective_engines(engines))


@memo_columns
def clean_url(url: Column | str) -> Column:
    """Drop leading blanks/control characters and every tab, CR and LF.

    Native string functions (no regexp): delete tab/CR/LF, then strip the
    leading run of characters U+0000..U+0020. Few URLs need it, and byte
    searches that find so cost less than rewriting every URL.
    """
    u = _col(url)
    dirty = u.contains("\t") | u.contains("\n") | u.contains("\r") | (F.substring(u, 1, 1) <= F.lit(" "))
    return F.when(dirty, F.ltrim(F.translate(u, "\t\r\n", ""), F.lit(_C0_OR_SPACE))).otherwise(u)


def _netloc_text(url: Column | str, cleaned: bool) -> Column:
    u = _col(url) if cleaned else clean_url(url)
    return F.regexp_extract(u, _NETLOC, 1)


def _engine_text(url: Column | str, strict: bool, cleaned: bool, engines) -> Column:
    """Engine domain or '' (two regexps: bracket-free netloc, then engine suffix)."""
    u = _col(url) if cleaned else clean_url(url)
    h = F.lower(F.regexp_extract(u, _PLAIN_NETLOC, 1))
    if not strict and not _can_fold(engines):
        h = F.regexp_replace(h, _LOOSE_PREFIX, "")
    return F.regexp_extract(h, engine_pattern(engines, strict=strict), 1)


@memo_columns
def netloc(url: Column | str, *, cleaned: bool = False) -> Column:
    """Network location (``user@host:port``) of a URL; NULL when there is none."""
    return F.nullif(_netloc_text(url, cleaned), F.lit(""))


@memo_columns
def host(url: Column | str, *, strict: bool = False, cleaned: bool = False) -> Column:
    """Lower-cased netloc without its ``www`` prefix; NULL when there is no netloc."""
    prefix = _STRICT_PREFIX if strict else _LOOSE_PREFIX
    return F.regexp_replace(F.lower(netloc(url, cleaned=cleaned)), prefix, "")


@memo_columns
def is_search(
    url: Column | str,
    *,
    strict: bool = False,
    cleaned: bool = False,
    engines: tuple[tuple[str, str], ...] = ENGINE_PARAMS,
) -> Column:
    """Exactly ``search_domain(url) IS NOT NULL``, written for filters.

    Catalyst pushes a filter below the projection that computes its column
    and inlines the expression; this form references the regexps once, so
    a pushed-down copy costs one parse per row (``IS NOT NULL`` over a
    ``nullif`` would evaluate them twice).
    """
    return _engine_text(url, strict, cleaned, engines) != F.lit("")


@memo_columns
def search_domain(
    url: Column | str,
    *,
    strict: bool = False,
    cleaned: bool = False,
    engines: tuple[tuple[str, str], ...] = ENGINE_PARAMS,
) -> Column:
    """Canonical engine domain (e.g. ``google.com``) of a referrer, else NULL."""
    return F.nullif(_engine_text(url, strict, cleaned, engines), F.lit(""))


@memo_columns
def query_string(url: Column | str, *, cleaned: bool = False) -> Column:
    """Raw query string (between ``?`` and ``#``); empty string when absent."""
    u = _col(url) if cleaned else clean_url(url)
    return F.regexp_extract(u, _QUERY, 1)


def decode_component(c: Column) -> Column:
    """``+`` to blank and percent decoding; malformed escapes stay literal.

    Bytes that are no UTF-8 become U+FFFD, one for each longest part that begins a
    character. Java's decoder does the same but for surrogates, which it takes for
    one whole; no character begins with their first two bytes, so each byte stands
    alone. Replacing the first one beforehand leaves the others alone.
    """
    literal = F.regexp_replace(c, _BAD_ESCAPE, "%25")
    whole = F.when(literal.contains("%"), F.regexp_replace(literal, _SURROGATE_LEAD, _REPLACEMENT)).otherwise(literal)
    return F.try_url_decode(whole)


@memo_columns
def query_param(url: Column | str, name: Column | str, *, cleaned: bool = False) -> Column:
    """First non-empty decoded value of query parameter ``name``, else NULL.

    ``name`` is a parameter name (str) or a Column holding one per row.
    """
    wanted = F.lit(name) if isinstance(name, str) else name
    pairs = F.split(query_string(url, cleaned=cleaned), "&")
    matching = F.filter(
        pairs,
        lambda p: (F.length(F.regexp_extract(p, _PAIR_VALUE, 1)) > 0)
        & (decode_component(F.regexp_extract(p, _PAIR_NAME, 1)) == wanted),
    )
    return decode_component(F.regexp_extract(F.get(matching, 0), _PAIR_VALUE, 1))


def keyword_param(domain: Column, engines: tuple[tuple[str, str], ...] = ENGINE_PARAMS) -> Column:
    """Name of the keyword parameter for an engine domain column."""
    expr = None
    for param, domains in params_by_engine(engines).items():
        cond = domain.isin(*domains)
        expr = F.when(cond, F.lit(param)) if expr is None else expr.when(cond, F.lit(param))
    return expr


@memo_columns
def search_keyword(
    url: Column | str,
    *,
    domain: Column | str | None = None,
    strict: bool = False,
    cleaned: bool = False,
    engines: tuple[tuple[str, str], ...] = ENGINE_PARAMS,
) -> Column:
    """Search keyword of a referrer (case kept), NULL unless it is a search engine.

    Pass ``domain`` when the engine column is already computed, so the host
    regexps are not evaluated twice; the query parse then only runs on rows
    whose domain is not NULL.
    """
    d = _col(domain) if domain is not None else search_domain(url, strict=strict, cleaned=cleaned, engines=engines)
    return F.when(d.isNotNull(), query_param(url, keyword_param(d, engines), cleaned=cleaned))
