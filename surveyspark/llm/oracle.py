"""SQL for the operators that SQL can express, for tables of the size that SQL is compared on."""

from __future__ import annotations

#: The letters that are lower-cased.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _crc32(text: str) -> str:
    """CRC-32 of ASCII text, bit by bit."""
    byte = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {byte}), 4294967295)"


def merkle_sql(levels: int = 8, upper: int = 3) -> str:
    """Trees of up to 8**levels documents a language, and 8**upper languages."""
    def field(c: str) -> str:
        return f"coalesce(strlen(cast({c} AS VARCHAR)) || ':' || cast({c} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"

    def grown(name: str, k: int, keys: str) -> str:
        return f"""
{name}{k + 1} AS MATERIALIZED (SELECT {keys} r // 8 AS r, (max(n) + 7) // 8 AS n,
  CASE WHEN max(n) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY r)) END AS h
  FROM {name}{k} GROUP BY {keys} r // 8),"""

    def sides(name: str, k: int, keys: str) -> str:
        run = f"string_agg(h, '') OVER (PARTITION BY {keys} r // 8 ORDER BY r ROWS BETWEEN"
        return f"""
{name}s{k} AS MATERIALIZED (SELECT {keys} r, n, coalesce({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
  coalesce({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b FROM {name}{k}),"""

    def climbed(made: str, come: str, side: str, on: str) -> str:
        return f"""
{made} AS MATERIALIZED (SELECT x.* REPLACE (x.r // 8 AS r, x.proof || s.a || s.b AS proof,
  CASE WHEN s.n = 1 THEN x.f ELSE sha256(s.a || x.f || s.b) END AS f) FROM {come} x JOIN {side} s ON {on} x.r = s.r),"""

    text = f"""
WITH d AS MATERIALIZED (SELECT doc_id, lang, {leaf('text')} AS h,
  CASE WHEN {_crc32('cast(doc_id AS VARCHAR)')} % 3 = 0 THEN {leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS c
  FROM documents),
f0 AS MATERIALIZED (SELECT doc_id, lang, h AS leaf, coalesce(c, h) AS f, '' AS proof, h,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS r,
  count(*) OVER (PARTITION BY lang) AS n FROM d),
t0 AS MATERIALIZED (SELECT lang, r, n, h FROM f0),"""
    same = "x.lang IS NOT DISTINCT FROM s.lang AND"
    for k in range(levels):
        text += grown("t", k, "lang,") + sides("t", k, "lang,") + climbed(f"f{k + 1}", f"f{k}", f"ts{k}", same)
    text += f"""
u0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS r, count(*) OVER () AS n, h, lang
  FROM t{levels}),
g0 AS MATERIALIZED (SELECT x.* REPLACE (u.r AS r), u.h AS subroot
  FROM f{levels} x JOIN u0 u ON x.lang IS NOT DISTINCT FROM u.lang),"""
    for k in range(upper):
        text += grown("u", k, "") + sides("u", k, "") + climbed(f"g{k + 1}", f"g{k}", f"us{k}", "")
    return text + f"""
top AS (SELECT h AS root FROM u{upper})
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified
FROM g{upper}, top"""


def divergence_sql() -> str:
    """Every group against every other on every kept term, counts of 0 included."""
    share = "1 + (1000000000::HUGEINT * ({n} + 1)) // ({total} + v)"
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS id, coalesce(text, '') AS t, coalesce(lang, '') AS lang,
  coalesce(source, '') AS source FROM documents),
w AS MATERIALIZED (SELECT id, lang, source,
  unnest(regexp_extract_all(translate(t, '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
c AS MATERIALIZED (SELECT w.lang, source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
l AS MATERIALIZED (SELECT lang, sum(n)::HUGEINT AS total, count(*) AS v FROM kept GROUP BY lang),
g AS MATERIALIZED (SELECT lang, source, coalesce(s.total, 0)::HUGEINT AS total, coalesce(v, 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN l USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) s USING (lang, source)),
p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
  {share.format(n='coalesce(c.n, 0)', total='g.total')} AS p
  FROM g JOIN kept k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS MATERIALIZED (SELECT lang, term, {share.format(n='n', total='total')} AS q FROM kept JOIN l USING (lang)),
pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
term AS (SELECT p.lang, source, term AS item, (p - q) * (p - q) // q AS value
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL SELECT lang, source, 'term', item, value FROM term)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
WHERE part = 'pair' OR rank <= 200"""
