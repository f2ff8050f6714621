"""Column functions of the ingest and output steps.

Every function here returns a ``Column`` built from Spark's own SQL functions,
so it runs inside whole-stage codegen and Catalyst can fold, prune and push it.
Spark evaluates regular expressions with ``java.util.regex`` and URL decoding
with ``java.net.URLDecoder``, which gives the documented semantics exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must stay exactly as they are for results to match.
#   record delimiter:        ":"  (the first one splits name from page)
#   page-name pattern:       ^([^~]+)$     (non-empty, no tilde)
#   link-target pattern:     ^\..*/([^~]+)\.html$   (group 1 is the target)
#   entity neutralisation:   "&" is replaced by "@amp;"
#   container:               <div id="bodyContent">
#   damping (teleport) α:    0.15;  rounds: 10;  top-k: 100
# ---------------------------------------------------------------------------
RECORD_DELIMITER = ":"
PAGE_NAME_PATTERN = r"^([^~]+)$"
LINK_TARGET_PATTERN = r"^\..*/([^~]+)\.html$"
ENTITY_FROM = "&"
ENTITY_TO = "@amp;"
CONTAINER = ("div", "id", "bodyContent")
ALPHA = 0.15
ITERATIONS = 10
TOP_K = 100

# Lenient mode (plain web HTML): links of the form href="/X" inside <nav>.
NAV_CONTAINER = ("nav", None, None)
NAV_LINK_PATTERN = r"^/(.+)$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def delimiter_pos(line: str | Column) -> Column:
    """1-based position of the first delimiter, 0 when there is none."""
    return F.instr(_col(line), RECORD_DELIMITER)


def record_name(line: str | Column) -> Column:
    """Text before the first delimiter (P1); null when there is no delimiter."""
    c = _col(line)
    return F.when(delimiter_pos(c) > 0, F.substring_index(c, RECORD_DELIMITER, 1))


def record_body(line: str | Column) -> Column:
    """Text after the first delimiter, later delimiters kept."""
    c = _col(line)
    pos = delimiter_pos(c)
    return F.when(pos > 0, c.substr(pos + 1, F.length(c)))


def name_ok(name: str | Column, pattern: str = PAGE_NAME_PATTERN) -> Column:
    """Page-name predicate (P4): false for null, empty and names with a tilde."""
    return F.coalesce(_col(name).rlike(pattern), F.lit(False))


def neutralise_entities(html: str | Column) -> Column:
    """Strict-mode entity neutralisation (P3): every '&' becomes '@amp;'."""
    return F.replace(_col(html), F.lit(ENTITY_FROM), F.lit(ENTITY_TO))


def decode_href(href: str | Column) -> Column:
    """URL-decode with fallback (P10): '+' and %XX decoded; raw text on a bad escape."""
    c = _col(href)
    return F.coalesce(F.try_url_decode(c), c)


def link_target(link: str | Column, pattern: str = LINK_TARGET_PATTERN) -> Column:
    """Group 1 of the link pattern (P11); null when the link does not match.

    The match test is ``rlike``, not an empty capture, so a pattern whose
    group can be empty still tells "no match" apart from "empty target".
    """
    c = _col(link)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 1))


def format_rank(rank: str | Column, decimals: int | None = None) -> Column:
    """Text form of a rank (P14): Java's double text by default, else fixed decimals."""
    c = _col(rank)
    if decimals is None:
        return c.cast("string")
    return F.format_string(f"%.{int(decimals)}f", c)


def ranked_line(name: str | Column, rank: str | Column, decimals: int | None = None) -> Column:
    """One output line ``name rank``."""
    return F.concat_ws(" ", _col(name), format_rank(rank, decimals))
