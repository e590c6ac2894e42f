"""DuckDB statements for the queries that SQL can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

URL_FILTER = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, row_number() OVER () AS r,
         coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM rest
), entries (entry, host_part, path_part, kind) AS (VALUES
  ('org/', 'org', '/', 'allow'),
  ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'),
  ('com/fr/', 'com', '/fr/', 'allow'),
  ('com/de/', 'com', '/de/', 'block'),
  ('cheap-pills.example.com/', 'cheap-pills.example.com', '/', 'listed'),
  ('spam-farm.example.org/', 'spam-farm.example.org', '/', 'listed')
), fits AS (
  SELECT r, arg_max(entry, length(entry)) FILTER (kind <> 'listed') AS rule,
         arg_max(kind, length(entry)) FILTER (kind <> 'listed') AS verdict,
         arg_max(entry, length(entry)) FILTER (kind = 'listed') AS listed
  FROM parts JOIN entries
    ON (host = host_part OR suffix(host, '.' || host_part)) AND prefix(path, path_part)
  GROUP BY r
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN listed IS NULL THEN 'allow' ELSE 'block' END) AS verdict, listed
FROM parts LEFT JOIN fits USING (r)
"""

ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)

SECRET_SCAN = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), found AS (
  SELECT r, 0 AS k, 'assign' AS kind, 8 AS least, regexp_extract_all(t, '{ASSIGN}') AS hits,
         regexp_extract_all(t, '{ASSIGN}', 2) AS owns, string_split_regex(t, '{ASSIGN}') AS gaps FROM d
  UNION ALL
  SELECT r, 1, 'access', 16, regexp_extract_all(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+'),
         string_split_regex(t, 'AKIA[A-Z0-9]+') FROM d
  UNION ALL
  SELECT r, 2, 'hex', 32, regexp_extract_all(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+'),
         string_split_regex(t, '[0-9a-f]+') FROM d
), parts AS (
  SELECT r, k, kind, least, unnest(hits) AS hit, unnest(owns) AS own, unnest(gaps[1:len(hits)]) AS gap,
         unnest(range(len(hits))) AS i
  FROM found WHERE len(hits) > 0
), ends AS (
  SELECT *, sum(length(hit) + length(gap)) OVER (PARTITION BY r, k ORDER BY i) AS e FROM parts
), spans AS (
  SELECT r, k, (e - length(hit))::BIGINT AS s, kind || ':' || (e - length(hit))::BIGINT || ':' || e::BIGINT AS span
  FROM ends WHERE length(own) >= least
), listed AS (
  SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
         string_agg(span, ',' ORDER BY s, k) AS spans
  FROM spans GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN listed USING (r)
"""

#: More levels than a tree of 3 ** 16 leaves has.
LEVELS = range(16)
#: crc32 of an ASCII text: for each byte, eight steps of the reflected polynomial.
CRC32 = (
    "xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split({0}, ''),"
    " lambda c: ascii(c)::UBIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)::UBIGINT[]),"
    " lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END)))"
)
PART = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(PART.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, group: str) -> list[str]:
    """CTEs {name}0, {name}1, ...: (group, i, d, n) of the nodes of a level; n is how many the tree has there."""
    out = []
    for k in LEVELS:
        out.append(
            f"{name}{k + 1} AS (SELECT {group}, i // 3 AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(d, '' ORDER BY i))"
            f" ELSE any_value(d) END AS d, (any_value(n) + 2) // 3 AS n FROM {name}{k} GROUP BY {group}, i // 3)"
        )
    return out


def _climb(out: str, start: str, place: str, name: str, group: str) -> list[str]:
    """CTEs {out}0, ...: per leaf its place, the siblings so far and the digest folded so far."""
    steps = [f"{out}0 AS (SELECT r, {group}, {place} AS i, proof, fold FROM {start})"]
    for k in LEVELS:
        sides = (
            f"SELECT a.r, string_agg(b.d, '' ORDER BY b.i) AS both_sides, coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,"
            f" coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS g, any_value(b.n) AS n"
            f" FROM {out}{k} a JOIN {name}{k} b ON a.{group} = b.{group} AND a.i // 3 = b.i // 3 AND a.i <> b.i GROUP BY a.r"
        )
        size = f"SELECT {group} AS g0, any_value(n) AS n0 FROM {name}{k} GROUP BY ALL"
        steps.append(
            f"{out}{k + 1} AS (SELECT a.r, a.{group}, a.i // 3 AS i, proof || coalesce(both_sides, '') AS proof,"
            f" CASE WHEN n0 > 1 THEN sha256(coalesce(l, '') || fold || coalesce(g, '')) ELSE fold END AS fold"
            f" FROM {out}{k} a JOIN ({size}) ON a.{group} = g0 LEFT JOIN ({sides}) s ON a.r = s.r)"
        )
    return steps


MERKLE = f"""
WITH l AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('1' || source, '0') AS s, {_leaf("text")} AS leaf,
         {_leaf("replace(text, chr(10), '')")} AS short FROM documents
), c AS (SELECT doc_id AS id, {CRC32.format("doc_id::VARCHAR")} % 2 = 0 AS doubted
    FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
), leaves AS (
  SELECT *, CASE WHEN doubted THEN short ELSE leaf END AS fold, '' AS proof,
         row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM l LEFT JOIN c ON doc_id = id
), t0 AS (SELECT s, p AS i, leaf AS d, count(*) OVER (PARTITION BY s) AS n FROM leaves),
{", ".join(_tree("t", "s"))},
subroots AS (SELECT s, d, row_number() OVER (ORDER BY s) - 1 AS q, count(*) OVER () AS n FROM t{len(LEVELS)}),
u0 AS (SELECT 0 AS top, q AS i, d, n FROM subroots),
{", ".join(_tree("u", "top"))},
{", ".join(_climb("a", "leaves", "p", "t", "s"))},
middle AS (SELECT r, 0 AS top, q, proof, fold FROM a{len(LEVELS)} JOIN subroots USING (s)),
{", ".join(_climb("b", "middle", "q", "u", "top"))}
SELECT doc_id, leaf, subroots.d AS subroot, u{len(LEVELS)}.d AS root, sha256(b.proof) AS proof_sha256, b.fold AS folded_root,
       b.fold = u{len(LEVELS)}.d AS verified
FROM leaves JOIN subroots USING (s) JOIN b{len(LEVELS)} b USING (r) CROSS JOIN u{len(LEVELS)}
"""

TERMS = f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

LEXICAL_SEARCH = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {TERMS} AS terms FROM documents
), asked AS (
  SELECT DISTINCT item_id, unnest({TERMS}) AS term FROM benchmark
), counted AS (
  SELECT count(*) AS documents, sum(len(terms))::BIGINT AS all_terms FROM d WHERE len(terms) > 0
), found AS (
  SELECT r, any_value(doc_id) AS doc_id, term, count(*) AS tf, any_value(n) AS n
  FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM asked) GROUP BY r, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(documents) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM found, counted GROUP BY term
), scored AS (
  SELECT item_id, doc_id, r,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * documents) // all_terms))))::BIGINT AS score
  FROM asked JOIN found USING (term) JOIN weights USING (term), counted GROUP BY item_id, doc_id, r
)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""

ORACLES: dict[str, str] = {"op1_url_filter": URL_FILTER, "op5_secret_scan": SECRET_SCAN, "op11_merkle_manifest": MERKLE, "op13_lexical_search": LEXICAL_SEARCH}
