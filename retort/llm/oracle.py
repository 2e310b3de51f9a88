"""DuckDB SQL for the corpus queries that SQL can express."""

BLANKS = "[ \\t-\\r]+"

RANKING = r"""WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
i AS (
  SELECT item_id, row_number() OVER () AS iid, unnest(list_distinct(
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)),
total AS (SELECT count(*) AS N, sum(len(terms))::BIGINT AS L FROM d WHERE len(terms) > 0),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * N + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
m AS (SELECT rid, doc_id, 100 - 50 + ((50 * len(terms) * N) // L) AS m FROM d, total WHERE len(terms) > 0),
s AS (SELECT i.iid, i.item_id, m.rid, m.doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
      FROM i JOIN tf USING (term) JOIN w USING (term) JOIN m USING (rid) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) <= 50"""


def quality(rules: dict[str, str], policy: str, mask: int, sole: tuple[str, ...], bits: dict[str, int]) -> str:
    """The ledger's SQL; the rules themselves are SQL that both engines read alike."""
    failed = " + ".join(f"CASE WHEN {rule} THEN {bits[name]} ELSE 0 END" for name, rule in rules.items())
    alone = " ".join(f"WHEN {bits[r]} THEN '{r}'" for r in sole)
    return rf"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, list_filter(regexp_split_to_array(t, '{BLANKS}'), lambda x: x <> '') AS words FROM d),
grams AS (SELECT rid, i, words[i : i + 2] AS g FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (SELECT rid, i FROM grams QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
repeats AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid),
lines AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
          FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^ \t-\r]') GROUP BY rid),
measured AS (
  SELECT d.doc_id, len(words) AS n_words, length(regexp_replace(t, '{BLANKS}', '', 'g')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(repeats.n, 0) AS n_repeat_words, len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS n_letter_words,
         len(regexp_extract_all(t, '[A-Za-z]')) AS n_letters, len(regexp_extract_all(t, '[A-Z]')) AS n_capitals
  FROM d JOIN w USING (rid) LEFT JOIN lines USING (rid) LEFT JOIN repeats USING (rid)),
judged AS (SELECT *, CAST({failed} AS BIGINT) AS failed, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND (failed & {mask}) = 0 AS kept,
       '{policy}' AS policy, failed, CASE (failed & {mask}) {alone} END AS sole_rule FROM judged"""
