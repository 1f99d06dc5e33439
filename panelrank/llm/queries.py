"""Registered queries of the operators, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelrank.llm import bpe, chat, collocations, conversation_repair, decontaminate, html_extract, line_dedup, lm_score, media, ngram_join, substring_dedup, toxicity, url_filter
from panelrank.llm.common import table


def tokenizer(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """Path and split pattern of a public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed_chunks", "n_removed_lines", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(lines, 1) - 1 AS i, unnest(lines) AS line, len(lines) AS n
  FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL AND text <> '')),
v AS (SELECT *, ('0x' || substr(md5(line), 1, 7))::BIGINT AS v FROM l),
c AS (
  SELECT *, i >= 1 AND (v + 65599 * lag(v, 1, 0) OVER w) % 65521 % 2 = 0 AS c
  FROM v WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
b AS (SELECT *, c AND NOT lag(c) OVER (PARTITION BY doc_id ORDER BY i) AND i <= n - 3 AS cut FROM c),
k AS (SELECT *, coalesce(sum(cut::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM b),
chunk AS (SELECT doc_id, k, string_agg(line, chr(10) ORDER BY i) AS t, count(*) AS n FROM k GROUP BY doc_id, k),
r AS (SELECT *, n > 1 AND row_number() OVER (PARTITION BY t ORDER BY doc_id, k) > 1 AS gone FROM chunk),
d AS (
  SELECT doc_id, sum(n) AS n_lines, count(*) FILTER (gone) AS n_removed_chunks, coalesce(sum(n) FILTER (gone), 0) AS n_removed_lines,
    coalesce(string_agg(t, chr(10) ORDER BY k) FILTER (NOT gone), '') AS kept FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed_chunks, 0)::BIGINT AS n_removed_chunks,
  coalesce(n_removed_lines, 0)::BIGINT AS n_removed_lines, sha256(coalesce(kept, '')) AS kept_sha256
FROM (SELECT doc_id FROM documents) LEFT JOIN d USING (doc_id)"""


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents: one row each."""
    leaks = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_join(F.sort_array(F.collect_set("item_id")).cast("array<string>"), ",")
    return leaks.groupBy("doc_id").agg(F.countDistinct("item_id").alias("n_items"), items.alias("items"), F.count("*").alias("n_leaks"), F.min("start").alias("first_start"), F.max("stop").alias("last_stop"))


OP2_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS d
  FROM documents WHERE text IS NOT NULL),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS t FROM benchmark),
bi AS (SELECT item_id, t, len(t) AS n, least(len(t), 13) AS l FROM b WHERE len(t) >= 8),
bg AS (SELECT item_id, unnest(range(1, n - 1)) AS j, t FROM bi),
bq AS (SELECT item_id, j, t[j] AS a, t[j+1] AS b, t[j+2] AS c FROM bg),
dg AS (SELECT doc_id, d AS words, unnest(range(1, len(d) - 1)) AS i FROM w),
dq AS (SELECT doc_id, i, words[i] AS a, words[i+1] AS b, words[i+2] AS c FROM dg),
h AS (SELECT DISTINCT doc_id, item_id, i - j AS o FROM dq JOIN bq USING (a, b, c)),
m AS (SELECT h.doc_id, h.item_id, o, n, l, list_transform(range(1, n + 1), lambda k: CASE WHEN k + o >= 1 AND w.d[k + o] = bi.t[k] THEN 1 ELSE 0 END) AS same
  FROM h JOIN w USING (doc_id) JOIN bi USING (item_id)),
g AS (SELECT *, list_filter(range(0, n - l + 1), lambda k: list_sum(same[k + 1 : k + l]) >= ceil(l * 0.8)) AS good FROM m)
SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list_distinct(list(item_id))), ',') AS items, count(*) AS n_leaks,
  min(o + list_min(good))::BIGINT AS first_start, max(o + list_max(good) + l)::BIGINT AS last_stop
FROM g WHERE len(good) > 0 GROUP BY doc_id"""


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
h AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS h FROM p),
m AS (SELECT h, min(doc_id) AS least FROM h GROUP BY h),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM h JOIN m USING (h) WHERE least < doc_id),
gone AS (SELECT doc_id, list(i) AS gone FROM g GROUP BY doc_id),
k AS (SELECT doc_id, w, i FROM (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM d) ANTI JOIN g USING (doc_id, i)),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS t FROM k GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text")
    )
    path, pattern = tokenizer()
    return chat.digests(chat.format_conversations(turns.unionByName(extra), path, pattern), path).drop("n_tokens")


OP4_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(regexp_replace(text, '(\\\\|</?s>|\[/?INST\]|\[/?SYS\]|\[/?ROLE\]|<\|endoftext\|>)', '\1x', 'g')) + length('</s>')
    + CASE role WHEN 'user' THEN 6 WHEN 'assistant' THEN 7 WHEN 'system' THEN 5 ELSE 13 + length(coalesce(role, '')) END)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id"""


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of `pages`, fetched on a day given by their id, against lists derived from the hosts themselves."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 365).cast("int")).alias("fetch_date"))
    domain = F.concat_ws(".", F.slice(F.split(url_filter.host_of(F.col("url")), r"\."), -3, 3))
    hosts = pages.select("url").where(F.size(F.split(url_filter.host_of(F.col("url")), r"\.")) >= 3).select(domain.alias("domain")).distinct()
    pick = F.conv(F.substring(F.md5("domain"), 1, 4), 16, 10).cast("int")
    named = F.col("domain").rlike("casino|pills|bets|adult|loan")
    change = lambda name, day, action: F.struct(F.lit(name).alias("list"), F.date_add(F.lit("2024-01-01").cast("date"), day.cast("int")).alias("date"), F.lit(action).alias("action"))
    spam = F.array(change("spam", pick % 120, "add"), change("spam", pick % 120 + 60, "remove"), change("spam", pick % 120 + 150, "add"))
    words = F.array(change("words", pick % 31, "add"))
    changes = F.concat(F.when(pick % 4 == 0, spam).otherwise(F.array().cast(spam_type(spam, hosts))), F.when(named, words).otherwise(F.array().cast(spam_type(spam, hosts))))
    entries = hosts.select("domain", F.explode(changes).alias("x")).select("domain", "x.*")
    return url_filter.filter_urls(pages, entries)


def spam_type(column, df: DataFrame):
    return df.select(column.alias("x")).schema["x"].dataType


OP5_SQL = r"""
WITH p AS (
  SELECT page_id, url, (DATE '2024-01-01' + (page_id % 365)::INT)::DATE AS fetch_date,
    nullif(regexp_replace(regexp_extract(lower(trim(url)), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/:?#]+)', 1), '^www\.|\.$', ''), '') AS host
  FROM pages),
d AS (SELECT DISTINCT regexp_extract(host, '[^.]+\.[^.]+\.[^.]+$') AS domain FROM p WHERE length(host) - length(replace(host, '.', '')) >= 2),
k AS (SELECT domain, ('0x' || substr(md5(domain), 1, 4))::INT AS pick FROM d),
c AS (
  SELECT domain, 'spam' AS list, DATE '2024-01-01' + pick % 120 AS f, DATE '2024-01-01' + (pick % 120 + 60) AS t FROM k WHERE pick % 4 = 0
  UNION ALL SELECT domain, 'spam', DATE '2024-01-01' + (pick % 120 + 150), DATE '9999-12-31' FROM k WHERE pick % 4 = 0
  UNION ALL SELECT domain, 'words', DATE '2024-01-01' + pick % 31, DATE '9999-12-31' FROM k WHERE regexp_matches(domain, 'casino|pills|bets|adult|loan')),
m AS (
  SELECT page_id, c.domain, c.list, row_number() OVER (PARTITION BY page_id ORDER BY length(c.domain) DESC, c.domain, c.list) AS r, count(*) OVER (PARTITION BY page_id) AS n
  FROM p JOIN c ON (p.host = c.domain OR ends_with(p.host, '.' || c.domain) AND NOT regexp_matches(p.host, '^\[|^[0-9.]+$')) AND p.fetch_date >= c.f AND p.fetch_date < c.t)
SELECT p.page_id, p.url, p.fetch_date, p.host, m.domain AS matched_domain, m.list AS matched_list, coalesce(m.n, 0)::BIGINT AS n_matches, m.n IS NOT NULL AS blocked
FROM p LEFT JOIN m ON p.page_id = m.page_id AND m.r = 1"""


def op6_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = media.inspect(media.store_bytes(docs, "text"))
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", F.col("dhash").alias("feature"), F.length("tile").cast("long").alias("tile_bytes"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    path, pattern = tokenizer()
    return bpe.digests(docs, path, pattern, keep=["doc_id"])


def held_out(modulus: int):
    """The contracts' hold-out rule: crc32 of the id as text has the remainder 2."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == 2


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: A text with at least this score counts as toxic.
TOXIC = 0.3


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    return toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), ~held_out(4))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select("doc_id", F.coalesce(held_out(4), F.lit(False)).alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lm_score.fit_and_score(docs, ~held_out(7))
    return scored.select("doc_id", F.coalesce(held_out(7), F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


OP11_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
o AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: ws[i : i + k - 1])) AS g FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k),
f AS MATERIALIZED (SELECT lang, k, g, count(*) AS n FROM o GROUP BY lang, k, g HAVING count(*) >= 30),
t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT lang, k, g, n AS a, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
s AS (SELECT c.lang, c.k, c.g, a, cut, x.n AS l, y.n AS r, (2000000::HUGEINT * a) // (x.n + y.n) AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.k = cut AND x.g = c.g[1 : cut] JOIN f y ON y.lang = c.lang AND y.k = c.k - cut AND y.g = c.g[cut + 1 : c.k]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
i AS (SELECT lang, n, unnest(flatten(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2), lambda j: g[j : j + m - 1])))) AS g FROM f WHERE k > 2),
m AS (SELECT lang, g, max(n) AS longest FROM i GROUP BY lang, g),
d AS (SELECT b.*, array_to_string(b.g, ' ') AS phrase FROM b LEFT JOIN m ON m.lang = b.lang AND m.g = b.g WHERE NOT coalesce(100 * longest::HUGEINT >= 80 * a::HUGEINT, false)),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM d)
SELECT z.lang, rank, phrase, a, l, z.r, t.n, score::BIGINT AS score FROM z JOIN t USING (lang) WHERE rank <= 2000"""


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_outside", "n_repeated", "n_article", "n_copied")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of the table, damaged by rule, and its repair."""
    turns = table(spark, sf_dir, "conversations")
    found = conversation_repair.report(conversation_repair.repair_chunks(conversation_repair.damaged(turns)))
    every = turns.select(F.col("conv_id").alias("of")).distinct()
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    rows = every.join(found, F.col("of").eqNullSafe(F.col("conv_id")), "left")
    return rows.select(F.col("of").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


OP13_SQL = r"""
WITH RECURSIVE t AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
c AS (SELECT *, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(k, ''), lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, b: xor(xor(a, b) >> 1, (xor(a, b) & 1) * 3988292384)), 4294967295) % 20 AS pick FROM t),
d AS (SELECT conv_id, turn, CASE WHEN pick = 4 THEN 'user' ELSE role END AS role,
    CASE pick WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE pick WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM c),
o AS (SELECT *, coalesce(conv_id::VARCHAR, '') || '|' || (conv_id IS NULL) AS g, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    count(*) OVER (PARTITION BY conv_id) AS n, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
    CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE '-' END AS ini, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last FROM d),
f AS MATERIALIZED (SELECT *, CASE WHEN last = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini NOT IN ('su', 'ua', 'au') AS wrong FROM o),
b(g, i, b0, b1, b2, b3) AS (
  SELECT g, n + 1, 0, 4, 2, 0 FROM f WHERE i = n
  UNION ALL
  SELECT g, i, least(x0, 2 + least(x2, x3 + 2)), least(x1, 2 + least(x2, x3 + 2)), least(x2, x3 + 2), least(x3, x2 + 2) FROM (
    SELECT f.g, f.i, f.fault IN ('blank', 'duplicate') AS gone, (f.fault = 'truncated')::INT AS late,
      CASE WHEN gone THEN b0 + 3 ELSE least(b0 + 3, b2 + 2 + late, CASE ini WHEN 's' THEN b1 + late WHEN 'u' THEN b2 + late ELSE 999999999 END) END AS x0,
      CASE WHEN gone THEN b1 + 3 ELSE least(b1 + 3, b2 + 2 + late, CASE ini WHEN 'u' THEN b2 + late ELSE 999999999 END) END AS x1,
      CASE WHEN gone THEN b2 + 3 ELSE least(b2 + 3, b3 + 2 + late, CASE ini WHEN 'a' THEN b3 + late ELSE 999999999 END) END AS x2,
      CASE WHEN gone THEN b3 + 3 ELSE least(b3 + 3, b2 + 2 + late, CASE ini WHEN 'u' THEN b2 + late ELSE 999999999 END) END AS x3
    FROM b JOIN f ON f.g = b.g AND f.i = b.i - 1)),
v AS MATERIALIZED (SELECT b.g, b.i, [b0, b1, b2, b3] AS v, ini, role, text, n, coalesce(fault IN ('blank', 'duplicate'), true) AS gone, coalesce((fault = 'truncated')::INT, 0) AS late
  FROM b LEFT JOIN f ON f.g = b.g AND f.i = b.i),
w(g, i, s, audit, made) AS (
  SELECT g, 1::BIGINT, 0, '', []::VARCHAR[] FROM f WHERE i = 1
  UNION ALL
  SELECT g, CASE WHEN edit = 'I' THEN i ELSE i + 1 END, to_s, audit || edit,
    CASE edit WHEN 'D' THEN made WHEN 'K' THEN list_append(made, role || ':' || text) ELSE list_append(made, CASE to_s WHEN 2 THEN 'user:' ELSE 'assistant:' END || CASE edit WHEN 'R' THEN text ELSE '' END) END
  FROM (SELECT w.*, v.role, v.text, CASE s WHEN 2 THEN 3 ELSE 2 END AS nx,
      CASE v.ini WHEN 's' THEN CASE s WHEN 0 THEN 1 END WHEN 'u' THEN CASE WHEN s <> 2 THEN 2 END WHEN 'a' THEN CASE s WHEN 2 THEN 3 END END AS kept,
      CASE WHEN z.v IS NOT NULL AND v.v[s + 1] = z.v[s + 1] + 3 THEN 'D' WHEN v.v[s + 1] = v.v[nx + 1] + 2 THEN 'I'
        WHEN kept IS NOT NULL AND NOT v.gone AND v.v[s + 1] = z.v[kept + 1] + v.late THEN 'K' ELSE 'R' END AS edit,
      CASE edit WHEN 'D' THEN s WHEN 'K' THEN kept ELSE nx END AS to_s
    FROM w JOIN v ON v.g = w.g AND v.i = w.i LEFT JOIN v z ON z.g = w.g AND z.i = w.i + 1 WHERE z.v IS NOT NULL OR w.s IN (1, 2))),
e AS (SELECT w.g, arg_max(audit, (w.i, length(audit))) AS audit, arg_max(made, (w.i, length(audit))) AS made FROM w GROUP BY w.g),
a AS (SELECT g, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (wrong) AS illegal FROM f GROUP BY g),
q AS (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, '') || '|' || (conv_id IS NULL) AS g FROM conversations)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(v.v[1], 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(made, chr(10)), '')) AS repaired_sha256
FROM q LEFT JOIN a USING (g) LEFT JOIN e USING (g) LEFT JOIN v ON v.g = q.g AND v.i = 1"""


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_decontamination, op3_substring_dedup, op4_chat_formatting, op5_url_filters, op6_media_columns, op7_byte_bpe, op8_ngram_jaccard, op9_toxicity, op10_lm_scoring, op11_collocations, op12_html_extraction, op13_conversation_repair)}
ORACLES = {"op3_substring_dedup": OP3_SQL, "op1_line_dedup": OP1_SQL, "op2_decontamination": OP2_SQL, "op4_chat_formatting": OP4_SQL, "op5_url_filters": OP5_SQL, "op11_collocations": OP11_SQL, "op13_conversation_repair": OP13_SQL}
