"""DuckDB SQL for the quality rules, from the same constants."""

from .quality import GRID, RATIOS


def counts_sql(table: str = "documents") -> str:
    return rf"""
rows_in AS (SELECT row_number() OVER () AS row_no, doc_id, lang, coalesce(text, '') AS text FROM {table}),
word_rows AS (SELECT row_no, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM rows_in),
line_rows AS (SELECT row_no, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS x FROM rows_in),
windows_at AS (
  SELECT row_no, i, array_to_string(w[i:i + 7], ' ') AS win
  FROM (SELECT row_no, w, unnest(range(1, len(w) - 6)) AS i FROM word_rows WHERE len(w) >= 8)),
twice AS (SELECT row_no, i FROM (SELECT row_no, i, count(*) OVER (PARTITION BY row_no, win) AS c FROM windows_at) WHERE c >= 2),
covered AS (
  SELECT row_no, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS n
  FROM (SELECT row_no, i, lead(i) OVER (PARTITION BY row_no ORDER BY i) AS nxt FROM twice) GROUP BY row_no),
base AS (
  SELECT r.row_no, r.doc_id, r.lang, len(w)::BIGINT AS n_words, len(x)::BIGINT AS n_lines,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols,
    (length(text) - length(regexp_replace(text, '[A-Z]+', '', 'g')))::BIGINT AS n_capitals,
    (length(text) - length(regexp_replace(text, '!+', '', 'g')))::BIGINT AS n_bangs,
    (len(x) - len(list_distinct(x)))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM rows_in r JOIN word_rows USING (row_no) JOIN line_rows USING (row_no) LEFT JOIN covered c USING (row_no)),
measured AS (
  SELECT *, CASE WHEN word_chars > 0 THEN n_symbols * 1000 // word_chars ELSE 0 END AS symbols,
    CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END AS dup_lines,
    CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words ELSE 0 END AS repeats,
    CASE WHEN word_chars > 0 THEN n_capitals * 1000 // word_chars ELSE 0 END AS capitals,
    CASE WHEN word_chars > 0 THEN n_bangs * 1000 // word_chars ELSE 0 END AS bangs,
    (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed
  FROM base)"""


def judged_sql(total_risk: float = 0.05, delta: float = 0.05) -> str:
    risk = total_risk / len(RATIOS)
    grid = ", ".join(map(str, GRID))
    return f"""{counts_sql()},
good AS (SELECT * FROM measured WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
strat AS (SELECT lang AS stratum, * FROM good WHERE lang IS NOT NULL UNION ALL SELECT '*', * FROM good),
long_form AS (UNPIVOT (SELECT stratum, {', '.join(RATIOS)} FROM strat) ON {', '.join(RATIOS)} INTO NAME ratio VALUE v),
tested AS (
  SELECT stratum, ratio, cutoff, count(*) AS n, count(*) FILTER (v >= cutoff) AS rejected
  FROM long_form, (SELECT unnest([{grid}]) AS cutoff) GROUP BY ALL),
tests AS (SELECT count(DISTINCT stratum) * {len(RATIOS) * len(GRID)} AS m FROM tested),
tails AS (
  SELECT t.*, m, CASE WHEN rejected <= n * {risk} THEN list_sum(list_transform(range(0, rejected + 1),
    lambda i: exp(lgamma((n + 1)::DOUBLE) - lgamma((i + 1)::DOUBLE) - lgamma((n - i + 1)::DOUBLE) + i * ln({risk}) + (n - i) * ln(1 - {risk})))) END AS tail
  FROM tested t, tests),
large AS (SELECT DISTINCT stratum FROM tails WHERE stratum = '*' OR n * ln(1 - {risk}) <= ln({delta}) - ln(m)),
cuts AS (
  SELECT l.stratum, {', '.join(f"min(cutoff) FILTER (ratio = '{r}' AND tail <= {delta} / m) AS cut_{r}" for r in RATIOS)}
  FROM large l LEFT JOIN tails t USING (stratum) GROUP BY l.stratum),
judged AS (
  SELECT d.*, NOT base_failed AND NOT ({' OR '.join(f"coalesce(d.{r} >= c.cut_{r}, false)" for r in RATIOS)}) AS kept
  FROM measured d LEFT JOIN cuts c ON c.stratum = coalesce((SELECT l.stratum FROM large l WHERE l.stratum = d.lang), '*'))"""


OP8_SQL = f"""WITH {judged_sql()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"""
