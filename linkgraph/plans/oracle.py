"""Independent SQL for every registered query, for DuckDB over the same parquet.

The rank rounds are unrolled into one ``MATERIALIZED`` CTE per round by a
plain string template; this is test SQL text, not a planner. Every float is
rounded to 10 decimals, and every column is aliased to the Spark name.
The fixed patterns are restated here on purpose: the oracle must not import
the code it checks.
"""

from __future__ import annotations

# Fixed values, which must stay as they are: damping, and the patterns of page
# names and of link targets.
ALPHA = 0.15
ROUND = 10
NAME_RE = "^([^~]+)$"
TARGET_RE = r"^\..*/([^~]+)\.html$"
NAV_RE = "^/(.+)$"

TRADE_EDGES = """
    SELECT 'C' || CAST(o.o_custkey AS VARCHAR) AS src, 'S' || CAST(l.l_suppkey AS VARCHAR) AS dst
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_returnflag <> 'R'
    UNION ALL
    SELECT 'S' || CAST(l.l_suppkey AS VARCHAR), 'C' || CAST(o.o_custkey AS VARCHAR)
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_returnflag = 'R'
    UNION ALL
    SELECT 'S' || CAST(l_suppkey AS VARCHAR), 'P' || CAST(l_partkey AS VARCHAR) FROM lineitem"""

# The recipe of the dump lines, as strings: containers by (page_id // 3) % 8,
# defects by (page_id // 7) % 3, and the links that a container adds by itself.
_CONTAINERS = """['<div id="bodyContent">', '<DIV id="BODYCONTENT">', '<div ID="bodyContent">',
    '<div id="bodyContent"><div id="bodyContent"><a href="../articles/in.html">i</a></div>',
    '<div id="bodyContent"><a href="../articles/first.html"/></div><p><a href="../articles/between.html">b</a></p><div id="bodyContent">',
    '<div id="bodyContent"><A href="../articles/up.html">u</A><a>none</a><a HREF="../articles/no.html">n</a>',
    '<div id="bodyContent">', '<div id="other">']"""
_OWN_LINKS = "[[], [], [], ['../articles/in.html'], ['../articles/first.html'], ['../articles/up.html'], [], []]"
_DEFECTS = """['<br>', '<b><i>x</b></i>', '<p x="1" x="2"></p>']"""
# A page's html with its anchors kept and all other markup as text.
_BODY = ("replace(replace(replace(replace(replace(replace("
         "regexp_replace(html, '<a href=\"/([^\"<>]*)\">([^<]*)</a>', chr(57344) || '\\1' || chr(57345) || '\\2' || chr(57346), 'g'),"
         " '<', '&lt;'), ']]>', ']]&gt;'), chr(57344), '<a href=\"../articles/'), chr(57345), '.html\">'), chr(57346), '</a>'), chr(10), ' ')")

WIKI_LINES = f"""
    SELECT page_id, body, third, own,
        CASE WHEN page_id % 25 = 24 THEN replace(name || rest, ':', ' ') ELSE name || ':' || rest END AS value
    FROM (SELECT *, CASE WHEN page_id % 10 = 9 THEN 'User~' ELSE '' END || 'p'
                || CAST(page_id - CASE WHEN page_id % 15 = 13 THEN 1 ELSE 0 END AS VARCHAR) AS name,
            CASE WHEN third = 6 THEN '<!DOCTYPE html SYSTEM "http://nowhere.invalid/x.dtd">' ELSE '' END
                || '<html><body>' || {_CONTAINERS}[third + 1] || body || '<a href="' || own || '">n</a>'
                || CASE WHEN page_id % 7 = 6 THEN {_DEFECTS}[(page_id // 7) % 3 + 1] ELSE '' END
                || CASE WHEN third = 1 THEN '</DIV>' ELSE '</div>' END
                || '<a href="./p0.html">out</a></body></html>' AS rest
          FROM (SELECT page_id, {_BODY} AS body, (page_id // 3) % 8 AS third,
                       '../articles/p' || CAST((page_id * 7 + 1) % 50 AS VARCHAR) || '.html' AS own FROM pages))"""


def decode(h: str) -> str:
    """URL decoding with fallback: a '%' not followed by two hex digits keeps the raw text."""
    return (f"CASE WHEN instr(regexp_replace({h}, '%[0-9A-Fa-f]{{2}}', '', 'g'), '%') > 0 "
            f"THEN {h} ELSE url_decode(replace({h}, '+', ' ')) END")


def capture(link: str, pattern: str = TARGET_RE) -> str:
    return f"CASE WHEN regexp_matches({link}, '{pattern}') THEN regexp_extract({link}, '{pattern}', 1) END"


# --- ingest of the wiki lines, from the recipe's keys --------------------------------------
# A defect makes a line ill-formed. Containers 2 and 7 are none (attribute name, value); the
# others hold their own links, the page's anchors and the line's own link, in this order.
WIKI_RECORDS = f"""
    lines AS ({WIKI_LINES}),
    recs AS (
        SELECT value, page_id, body, third, own,
               CASE WHEN instr(value, ':') > 0 THEN substr(value, 1, instr(value, ':') - 1) END AS page,
               CASE WHEN instr(value, ':') > 0 THEN substr(value, instr(value, ':') + 1) END AS html
        FROM lines),
    status AS (
        SELECT *, CASE WHEN page IS NULL THEN 'no_delimiter'
                    WHEN NOT regexp_matches(page, '{NAME_RE}') THEN 'bad_name'
                    WHEN page_id % 7 = 6 THEN 'ill_formed'
                    ELSE 'ok' END AS reason
        FROM recs),
    acc AS (SELECT page, body, third, own FROM status WHERE reason = 'ok'),
    hrefs AS (
        SELECT page, unnest(hs) AS href, unnest(generate_series(0, len(hs) - 1)) AS pos
        FROM (SELECT page, list_concat(list_concat({_OWN_LINKS}[third + 1],
                  regexp_extract_all(replace(body, '&', '@amp;'), '<a href="([^"]*)">', 1)), [own]) AS hs
              FROM acc WHERE third NOT IN (2, 7))),
    wlinks AS (
        SELECT page, pos, href, {capture(decode('href'))} AS target FROM hrefs),
    wiki_edges AS (SELECT page AS src, target AS dst FROM wlinks WHERE target IS NOT NULL),
    wiki_pages AS (SELECT page AS id FROM acc)"""

NAV_RECORDS = f"""
    navp AS (SELECT 'p' || CAST(page_id AS VARCHAR) AS page,
                    regexp_extract(html, '<nav>.*?</nav>', 0) AS nav FROM pages),
    nhrefs AS (
        SELECT page, unnest(hs) AS href, unnest(generate_series(0, len(hs) - 1)) AS pos
        FROM (SELECT page, regexp_extract_all(nav, '<a [^>]*href="([^"]*)"', 1) AS hs FROM navp)),
    nlinks AS (SELECT page, pos, href, {capture(decode('href'), NAV_RE)} AS target FROM nhrefs),
    nav_edges AS (SELECT page AS src, target AS dst FROM nlinks WHERE target IS NOT NULL),
    nav_pages AS (SELECT page AS id FROM navp)"""


def graph_ctes(edges: str, pages: str | None = None) -> str:
    """pairs / outs / nodes / nn over an edge relation (and optional page relation)."""
    page_part = f"UNION ALL SELECT id, true FROM {pages}" if pages else ""
    return f"""
    pairs AS MATERIALIZED (SELECT src, dst, count(*) AS mult FROM {edges} GROUP BY src, dst),
    outs AS MATERIALIZED (
        SELECT src, CAST(sum(mult) AS BIGINT) AS out_degree, count(*) AS n_targets
        FROM pairs GROUP BY src),
    nodes AS MATERIALIZED (
        SELECT u.id, coalesce(o.out_degree, 0) AS out_degree, o.src IS NULL AS dangling, u.is_page
        FROM (SELECT id, bool_or(is_page) AS is_page FROM (
                  SELECT src AS id, true AS is_page FROM pairs
                  UNION ALL SELECT dst, false FROM pairs {page_part}) GROUP BY id) u
        LEFT JOIN outs o ON o.src = u.id),
    nn AS MATERIALIZED (SELECT CAST(count(*) AS DOUBLE) AS n FROM nodes)"""


def _contrib_sums(prev: str) -> str:
    return f"""SELECT pr.dst AS id, sum((pr.mult / o.out_degree) * r.rank) AS s
               FROM pairs pr JOIN outs o ON o.src = pr.src JOIN {prev} r ON r.id = pr.src
               GROUP BY pr.dst"""


def _round_cte(i: int, n_rel: str = "nn", fixed_delta: float | None = None) -> str:
    prev = f"r{i - 1}"
    if fixed_delta is None:
        delta = (f"(SELECT coalesce(sum(p.rank), 0.0) FROM {prev} p JOIN nodes q ON p.id = q.id "
                 f"WHERE q.dangling)")
    else:
        delta = f"CAST({fixed_delta!r} AS DOUBLE)"
    n = f"(SELECT n FROM {n_rel})"
    return f"""
    r{i} AS MATERIALIZED (
        SELECT v.id, r.rank AS prev,
               CAST({ALPHA!r} AS DOUBLE) / {n} + CAST({1 - ALPHA!r} AS DOUBLE)
                 * ({delta} / {n} + coalesce(c.s, 0.0)) AS rank
        FROM nodes v
        JOIN {prev} r ON r.id = v.id
        LEFT JOIN ({_contrib_sums(prev)}) c ON c.id = v.id)"""


def rank_ctes(iterations: int) -> str:
    first = "r0 AS MATERIALIZED (SELECT id, CAST(1 AS DOUBLE) / (SELECT n FROM nn) AS rank FROM nodes)"
    return ",\n".join([first] + [_round_cte(i) for i in range(1, iterations + 1)])


def rank_sql(prefix: str, edges: str, pages: str | None = None, iterations: int = 10,
             pages_only: bool = False) -> str:
    """Unrolled rounds; ``pages_only`` keeps page vertices in the result."""
    where = " WHERE id IN (SELECT id FROM nodes WHERE is_page)" if pages_only else ""
    return (f"WITH {prefix}, {graph_ctes(edges, pages)}, {rank_ctes(iterations)}\n"
            f"SELECT id, round(rank, {ROUND}) AS rank FROM r{iterations}{where}")


def trade_prefix() -> str:
    return f"trade_edges AS MATERIALIZED ({TRADE_EDGES})"


def trace_sql(iterations: int = 10) -> str:
    parts = []
    for i in range(1, iterations + 1):
        parts.append(f"""SELECT CAST({i} AS BIGINT) AS iteration,
                   round(sum(r.rank), {ROUND}) AS rank_sum,
                   round(coalesce(sum(CASE WHEN v.dangling THEN r.rank END), 0.0), {ROUND}) AS dangling_mass,
                   round(max(abs(r.rank - r.prev)), {ROUND}) AS max_change,
                   round(sum(abs(r.rank - r.prev)), {ROUND}) AS l1_change
            FROM r{i} r JOIN nodes v ON v.id = r.id""")
    return (f"WITH {trade_prefix()}, {graph_ctes('trade_edges')}, {rank_ctes(iterations)}\n"
            + "\nUNION ALL\n".join(parts))


def until_tol_sql(tol: float, iterations: int = 10) -> str:
    """Ranks of the first round whose L1 change is below ``tol`` (else the last)."""
    l1 = " UNION ALL ".join(f"SELECT {i} AS it, sum(abs(rank - prev)) AS l1 FROM r{i}"
                            for i in range(1, iterations + 1))
    stop = f"stop AS (SELECT coalesce(min(it), {iterations}) AS it FROM ({l1}) WHERE l1 < {tol!r})"
    picks = " UNION ALL ".join(
        f"SELECT id, rank, CAST({i} AS BIGINT) AS iterations FROM r{i} WHERE (SELECT it FROM stop) = {i}"
        for i in range(1, iterations + 1))
    return (f"WITH {trade_prefix()}, {graph_ctes('trade_edges')}, {rank_ctes(iterations)}, {stop}\n"
            f"SELECT id, round(rank, {ROUND}) AS rank, iterations FROM ({picks})")


def active_sql(tol: float, iterations: int = 10) -> str:
    """Rounds in which a vertex sends the difference to what it has sent, once that is over tol/4 in proportion;
    the first round whose L1 change is below tol/2 (else the last), with the number of vertices that would send next."""
    n = "(SELECT n FROM nn)"

    def sends(r: str) -> str:
        return (f"({r}.id IN (SELECT src FROM outs) AND abs({r}.rank - {r}.sent) > "
                f"CAST({tol / 4!r} AS DOUBLE) * ({r}.rank + CAST(1 AS DOUBLE) / {n}))")

    ctes = [f"a0 AS MATERIALIZED (SELECT id, CAST(1 AS DOUBLE) / {n} AS prev, CAST(1 AS DOUBLE) / {n} AS rank, "
            f"CAST(0 AS DOUBLE) AS sent, CAST(0 AS DOUBLE) AS c FROM nodes)"]
    for i in range(1, iterations + 1):
        p = f"a{i - 1}"
        ctes.append(f"""
    c{i} AS MATERIALIZED (
        SELECT p.id, p.rank AS prev, CASE WHEN {sends('p')} THEN p.rank ELSE p.sent END AS sent, p.c + coalesce(x.s, 0.0) AS c
        FROM {p} p LEFT JOIN (
            SELECT pr.dst AS id, sum((pr.mult / o.out_degree) * (r.rank - r.sent)) AS s
            FROM pairs pr JOIN outs o ON o.src = pr.src JOIN {p} r ON r.id = pr.src WHERE {sends('r')} GROUP BY pr.dst) x ON x.id = p.id),
    a{i} AS MATERIALIZED (
        SELECT id, prev, CAST({ALPHA!r} AS DOUBLE) / {n} + CAST({1 - ALPHA!r} AS DOUBLE)
               * ((SELECT coalesce(sum(p.rank), 0.0) FROM {p} p JOIN nodes q ON p.id = q.id WHERE q.dangling) / {n} + c) AS rank, sent, c
        FROM c{i})""")
    l1 = " UNION ALL ".join(f"SELECT {i} AS it, sum(abs(rank - prev)) AS l1, (SELECT count(*) FROM a{i} s WHERE {sends('s')}) AS senders FROM a{i}"
                            for i in range(1, iterations + 1))
    stop = f"per_round AS ({l1}), stop AS (SELECT coalesce(min(it) FILTER (l1 < {tol / 2!r}), {iterations}) AS it FROM per_round)"
    picks = " UNION ALL ".join(f"SELECT id, rank, CAST({i} AS BIGINT) AS iterations FROM a{i} WHERE (SELECT it FROM stop) = {i}"
                               for i in range(1, iterations + 1))
    return (f"WITH {trade_prefix()}, {graph_ctes('trade_edges')}, {', '.join(ctes)}, {stop}\n"
            f"SELECT id, round(rank, {ROUND}) AS rank, iterations, CAST(senders AS BIGINT) AS senders "
            f"FROM ({picks}) JOIN per_round ON it = iterations")


def parity_sql() -> str:
    r0 = ("r0 AS MATERIALIZED (SELECT id, CASE WHEN is_page THEN CAST(1 AS DOUBLE) / (SELECT n FROM nrec) "
          "ELSE 0.0 END AS rank FROM nodes)")
    nrec = "nrec AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM acc)"
    return (f"WITH {WIKI_RECORDS}, {graph_ctes('wiki_edges', 'wiki_pages')}, {nrec}, {r0},"
            f"{_round_cte(1, 'nrec', 0.0)}\nSELECT id, round(rank, {ROUND}) AS rank FROM r1")


def first_round_sql(select: str) -> str:
    """Trade graph with r0, for the single-round operator checks."""
    r0 = "r0 AS MATERIALIZED (SELECT id, CAST(1 AS DOUBLE) / (SELECT n FROM nn) AS rank FROM nodes)"
    return f"WITH {trade_prefix()}, {graph_ctes('trade_edges')}, {r0}\n{select}"


def trade_select(select: str) -> str:
    return f"WITH {trade_prefix()}, {graph_ctes('trade_edges')}\n{select}"


def link_variants() -> str:
    """Link words of every page turned into test hrefs of nine shapes."""
    return """
    words AS (
        SELECT page_id, unnest(ws) AS w, unnest(generate_series(0, len(ws) - 1)) AS pos
        FROM (SELECT page_id, regexp_extract_all(html, 'href="/([^"]*)"', 1) AS ws FROM pages))"""


TARGET_SHAPES = ["'./' || w || '.html'", "'../x/' || w || '.html'", "'../u~v/' || w || '.html'",
                 "'../x/' || w || '~1.html'", "'./' || w || '/.html'", "'http://h/' || w || '.html'",
                 "'./' || w || '.html#s'", "'../x/' || w || '.HTML'", "w || '.html'"]
DECODE_SHAPES = ["w || '%20x'", "w || '+y'", "w || '%ZZ'", "w || '%C3%A9'", "w || '%'",
                 "'%7E' || w", "w || '%2Fz'"]


def _shape_case(shapes: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN {s}" for i, s in enumerate(shapes))
    return f"CASE (page_id + pos) % {len(shapes)} {whens} END"


def queries() -> dict[str, str]:
    r = ROUND
    q: dict[str, str] = {}
    q["record_split"] = f"""WITH {WIKI_RECORDS}
        SELECT page, md5(html) AS html_md5, page IS NOT NULL AS delimited FROM recs"""
    q["page_name_filter"] = f"""WITH {WIKI_RECORDS}
        SELECT page, regexp_matches(page, '{NAME_RE}') AS name_ok FROM recs WHERE page IS NOT NULL"""
    q["entity_neutralise"] = """
        SELECT page_id, md5(replace(html, '&', '@amp;')) AS html_md5 FROM pages"""
    q["link_target_capture"] = f"""WITH {link_variants()},
        hs AS (SELECT page_id, pos, {_shape_case(TARGET_SHAPES)} AS href FROM words)
        SELECT page_id, pos, href, {capture('href')} AS target FROM hs"""
    q["link_decode"] = f"""WITH {link_variants()},
        hs AS (SELECT page_id, pos, {_shape_case(DECODE_SHAPES)} AS href FROM words)
        SELECT page_id, pos, href, {decode('href')} AS decoded FROM hs"""
    q["strict_link_extract"] = f"""WITH {WIKI_RECORDS}
        SELECT page, pos, href, target FROM wlinks WHERE target IS NOT NULL"""
    q["lenient_link_extract"] = f"""WITH {NAV_RECORDS}
        SELECT page, pos, href, target FROM nlinks WHERE target IS NOT NULL"""
    q["dump_scan"] = q["strict_link_extract"]
    q["ingest_report"] = f"""WITH {WIKI_RECORDS}
        SELECT reason, count(*) AS n FROM status GROUP BY reason"""
    q["adjacency_merge"] = trade_select("SELECT src, dst, mult FROM pairs")
    q["node_universe"] = trade_select("SELECT id FROM nodes")
    q["out_degree"] = trade_select("SELECT src, out_degree, n_targets FROM outs")
    q["dangling_nodes"] = trade_select(
        "SELECT n.id FROM nodes n WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.src = n.id)")
    q["initial_rank"] = first_round_sql(f"SELECT id, round(rank, {r}) AS rank FROM r0")
    q["edge_contributions"] = first_round_sql(
        f"""SELECT pr.src, pr.dst, round((pr.mult / o.out_degree) * r.rank * (SELECT n FROM nn), {r}) AS contribution
            FROM pairs pr JOIN outs o ON o.src = pr.src JOIN r0 r ON r.id = pr.src""")
    q["contribution_sum"] = first_round_sql(
        f"""SELECT v.id, round(coalesce(c.s, 0.0), {r}) AS contrib_sum
            FROM nodes v LEFT JOIN ({_contrib_sums('r0')}) c ON c.id = v.id""")
    q["dangling_mass"] = first_round_sql(
        f"""SELECT round(coalesce(sum(r.rank), 0.0), {r}) AS dangling_mass
            FROM r0 r JOIN nodes v ON v.id = r.id WHERE v.dangling""")
    q["rank_step_parity"] = parity_sql()
    q["rank_10"] = rank_sql(trade_prefix(), "trade_edges")
    q["rank_10_split"] = q["rank_10"]
    q["rank_10_wiki"] = rank_sql(WIKI_RECORDS, "wiki_edges", "wiki_pages")
    q["rank_10_nav"] = rank_sql(NAV_RECORDS, "nav_edges", "nav_pages")
    q["rank_10_wiki_pages"] = rank_sql(WIKI_RECORDS, "wiki_edges", "wiki_pages", pages_only=True)
    q["adjacency_snapshot"] = q["adjacency_merge"]
    q["rank_snapshot"] = q["rank_10"]
    q["rank_trace"] = trace_sql()
    q["rank_until_tol"] = until_tol_sql(TOL)
    q["rank_active_set"] = active_sql(ACTIVE_TOL)
    top = f"SELECT id AS name, rank FROM r10 ORDER BY rank DESC, id LIMIT 100"
    q["top_100"] = (f"WITH {trade_prefix()}, {graph_ctes('trade_edges')}, {rank_ctes(10)}\n"
                    f"SELECT name, round(rank, {r}) AS rank FROM ({top})")
    q["top_100_text"] = (f"WITH {trade_prefix()}, {graph_ctes('trade_edges')}, {rank_ctes(10)}\n"
                         f"SELECT name || ' ' || printf('%.{r}f', rank) AS value FROM ({top})")
    q["ranked_text_roundtrip"] = q["top_100_text"]
    q["top_100_exclude"] = (f"WITH {trade_prefix()}, {graph_ctes('trade_edges')}, {rank_ctes(10)}\n"
                            f"SELECT id AS name, round(rank, {r}) AS rank FROM r10 "
                            f"WHERE id NOT IN ('S1', 'S2', 'S3', 'S10', 'C1') ORDER BY r10.rank DESC, id LIMIT 100")
    return q


# Early-stop threshold of the ``rank_until_tol`` query (L1 change between rounds).
TOL = 2e-3
# Tolerance of ``rank_active_set``.
ACTIVE_TOL = 4e-3
