"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_STRENGTH = """
  SELECT 1 / least(greatest(coalesce(
           (sum(n * power(bad / n - up, 2)) - sum(up * (1 - up))) / nullif(sum((n - 1) * up * (1 - up)), 0),
           0.5), 0.0001), 0.99) - 1 AS m
  FROM {groups} WHERE n > 1"""

OP7 = f"""
WITH parsed AS (
  SELECT page_id, translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{_UPPER}', '{_LOWER}') host,
         regexp_extract(u, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) path
  FROM (SELECT page_id, coalesce(url, '') u FROM pages)),
outcome AS (
  SELECT doc_id page_id, count(*) n,
         sum(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) bad
  FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id),
named AS (
  SELECT host, array_to_string(list_slice(string_split(host, '.'), -least(k, len(string_split(host, '.'))), -1), '.') suffix,
         array_to_string(list_slice(string_split(host, '.'), -least(k + 1, len(string_split(host, '.'))), -1), '.') AS domain,
         sum(coalesce(n, 0))::DOUBLE n, sum(coalesce(bad, 0))::DOUBLE bad
  FROM (SELECT *, CASE WHEN regexp_matches(host,
          '(^|\\.)(ac|co|com|edu|gob|gov|ltd|mil|net|nom|or|org|plc|sch)\\.[a-z][a-z]$') THEN 2 ELSE 1 END AS k FROM parsed)
       LEFT JOIN outcome USING (page_id) GROUP BY host, k),
total AS (SELECT coalesce(sum(bad) / nullif(sum(n), 0), 0.0) mu FROM named),
s0 AS (SELECT suffix, sum(n) n, sum(bad) bad, any_value(mu) up FROM named, total GROUP BY suffix),
s AS (SELECT suffix, (bad + m * up) / (n + m) mean FROM s0, ({_STRENGTH.format(groups='s0')})),
d0 AS (SELECT domain, sum(n) n, sum(bad) bad, any_value(s.mean) up FROM named JOIN s USING (suffix) GROUP BY domain),
d AS (SELECT domain, (bad + m * up) / (n + m) mean FROM d0, ({_STRENGTH.format(groups='d0')})),
h0 AS (SELECT host, n, bad, d.mean up FROM named JOIN d USING (domain)),
h AS (SELECT host, n, (bad + m * up) / (n + m) mean, n + m w FROM h0, ({_STRENGTH.format(groups='h0')})),
b AS (SELECT host, n, mean, greatest(0, mean - 1.645 * sqrt(mean * (1 - mean) / (w + 1))) lo FROM h),
fits AS (
  SELECT page_id, host, path, n, mean, lo, [r FOR r IN [
      {{'v': 'allow', 'h': 'com', 'p': '/'}}, {{'v': 'block', 'h': 'example.com', 'p': '/en/'}},
      {{'v': 'allow', 'h': 'www.example.com', 'p': '/en/'}}, {{'v': 'block', 'h': 'net', 'p': '/es/'}},
      {{'v': 'block', 'h': 'net', 'p': '/fr/'}}]
    IF (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.p)] f
  FROM parsed JOIN b USING (host)),
best AS (
  SELECT *, CASE WHEN len(f) = 0 THEN NULL ELSE list_reduce(f, lambda x, y:
    CASE WHEN length(x.h || x.p) >= length(y.h || y.p) THEN x ELSE y END) END r FROM fits)
SELECT page_id, host, path, r.h || r.p AS rule,
       coalesce(r.v, CASE WHEN lo > 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
       n::BIGINT AS host_labels, round(mean, 6) AS bad_mean, round(lo, 6) AS bad_lower
FROM best
"""

OP3 = f"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, '{_UPPER}', '{_LOWER}'),
           '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') w FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(text, '{_UPPER}', '{_LOWER}'),
           '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') w FROM benchmark),
dw AS (SELECT doc_id, unnest(w) word, generate_subscripts(w, 1) - 1 p FROM d),
bw AS (SELECT item_id, len(w) n, unnest(w) word, generate_subscripts(w, 1) - 1 q FROM b WHERE len(w) >= 3),
-- every pair of equal words, on its diagonal: no seeds
eq AS (SELECT doc_id, item_id, n, p - q AS shift, q FROM dw JOIN bw USING (word)),
runs AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id, item_id, shift ORDER BY q
                           RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING) c
  FROM eq QUALIFY count(*) OVER (PARTITION BY doc_id, item_id, shift) >= least(n, 13) * 0.8),
starts AS (  -- window starts need not be equal words themselves
  SELECT doc_id, item_id, n, shift, s.s AS s, count(*) c
  FROM runs, LATERAL (SELECT unnest(range(greatest(q - least(n, 13) + 1, 0), least(q, n - least(n, 13)) + 1)) s) s
  GROUP BY doc_id, item_id, n, shift, s.s
  HAVING count(*) >= CASE WHEN n >= 13 THEN 11 WHEN n >= 8 THEN n - 1 ELSE n END),
span AS (
  SELECT doc_id, item_id, n, shift, min(s) a, max(s) + least(n, 13) z FROM starts
  GROUP BY doc_id, item_id, n, shift),
scored AS (
  SELECT span.doc_id, span.item_id, span.n, span.shift, a, z, count(*) e
  FROM span JOIN eq ON eq.doc_id = span.doc_id AND eq.item_id = span.item_id
       AND eq.shift = span.shift AND q >= a AND q < z
  GROUP BY span.doc_id, span.item_id, span.n, span.shift, a, z)
SELECT doc_id, item_id, shift + a AS doc_start, shift + z AS doc_end, a AS item_start, z AS item_end,
       e AS n_equal, z - a AS n_overlap, n AS item_words
FROM scored QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY e DESC, shift, a, z) = 1
"""

OP12 = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') u,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) h FROM documents),
r AS (
  SELECT doc_id, t, u, len(u) n, [CAST('0x' || substr(h, 8 * i + 1, 8) AS UBIGINT) FOR i IN range(4)] h FROM d),
k AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) a, greatest(h[1] % (n + 1), h[2] % (n + 1)) b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 100
              THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END form FROM r),
c AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') p, coalesce(array_to_string(u[a + 1:b], ''), '') m,
         coalesce(array_to_string(u[b + 1:], ''), '') s FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM c
"""


def _merkle(depth: int = 10) -> str:
    """Trees of up to 8^depth leaves a language, and as many languages."""
    def field(c):
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    def leaf(text):
        return "sha256(" + " || ".join([*map(field, ("doc_id", "source", "lang", "n_chars")), field(text)]) + ")"

    out = [f"""WITH RECURSIVE bits AS (
  SELECT b, list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
                        b) c FROM range(256) t(b)),
codes AS (SELECT list(c ORDER BY b) z FROM bits),
ids AS (SELECT DISTINCT coalesce(CAST(doc_id AS VARCHAR), '') v FROM documents),
crc AS (
  SELECT v, xor(list_reduce([ascii(x) FOR x IN string_split(v, '') IF x <> ''],
                     lambda c, x: xor(c >> 8, z[CAST(xor(c, x) & 255 AS INT) + 1]), 4294967295), 4294967295) c
  FROM ids, codes),
l AS (
  SELECT d.doc_id, coalesce('=' || lang, '-') t, {leaf('text')} h,
         CASE WHEN c % 3 = 0 THEN {leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END g
  FROM documents d JOIN crc ON v = coalesce(CAST(doc_id AS VARCHAR), '')),
n0 AS (
  SELECT doc_id, t, h, g, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, h) - 1 i,
         count(*) OVER (PARTITION BY t) n FROM l)"""]

    def climb(name, tree):
        for k in range(depth):
            run = f"PARTITION BY {tree}, i // 8 ORDER BY i"
            out.append(f"""{name}s{k} AS (
  SELECT {tree}, i, n, h,
         CASE WHEN n > 1 THEN coalesce(string_agg(h, '') OVER ({run} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), '')
              ELSE '' END b,
         CASE WHEN n > 1 THEN coalesce(string_agg(h, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING), '')
              ELSE '' END a FROM {name}{k}),
{name}{k + 1} AS (
  SELECT {tree}, i // 8 i, any_value((n + 7) // 8) n,
         CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END h
  FROM {name}{k} GROUP BY {tree}, i // 8)""")

    def fold(src, name, tree, key):
        for k in range(depth):
            out.append(f"""{src}{k + 1} AS (
  SELECT r.* REPLACE (p || b || a AS p, CASE WHEN s.n > 1 THEN sha256(b || f || a) ELSE f END AS f, r.{key} // 8 AS {key})
  FROM {src}{k} r JOIN {name}s{k} s ON r.{tree} = s.{tree} AND r.{key} = s.i)""")

    climb("n", "t")
    out.append(f"""m0 AS (
  SELECT 1 u, t, h, row_number() OVER (ORDER BY t) - 1 i, count(*) OVER () n FROM n{depth})""")
    climb("m", "u")
    out.append("r0 AS (SELECT doc_id, t, h AS leaf, coalesce(g, h) f, '' p, i FROM n0)")
    fold("r", "n", "t", "i")
    out.append(f"q0 AS (SELECT r.*, 1 u, m0.i j, m0.h sub FROM r{depth} r JOIN m0 USING (t))")
    fold("q", "m", "u", "j")
    return ",\n".join(out) + f"""
SELECT q.doc_id, q.leaf, q.sub AS subroot, m.h AS root, sha256(q.p) AS proof_sha256, q.f AS folded_root,
       q.f = m.h AS verified
FROM q{depth} q, m{depth} m
"""


ORACLE = {"op12_fill_in_middle": OP12, "op13_merkle_manifest": _merkle(), "op3_spaced_seed_decontam": OP3, "op7_url_filter": OP7}
