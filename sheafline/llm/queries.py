"""The registered queries of the dealt operators and the SQL that each must agree with, where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.llm import bpe, chat, license_scan, max_sketch, mixing, ngram_join, packing, period_runs, quality, rp_forest, rules, secret_scan, toxicity
from sheafline.llm.common import stored, table, words_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def register(name: str, sql: str | None = None):
    """Add a query under ``name``."""

    def add(run):
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return add


@register(
    "op4_quality_rules",
    rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
           FROM documents),
tri AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, t) AS c FROM tri) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest(range(0, 3)) AS k) GROUP BY doc_id),
base AS (
  SELECT doc_id, text, len(l) AS n_lines, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN cov USING (doc_id)),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
                  list_filter(string_split(text, chr(10) || chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS pa FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (100 * n_symbols > 20 * n_words) AND NOT (100 * n_dup_lines > (CASE WHEN n_lines >= 10 THEN 30 ELSE 60 END) * n_lines)
       AND NOT (word_chars < 2 * n_words OR word_chars > 15 * n_words)
       AND NOT (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 40 * word_chars)
       AND NOT (100 * length(regexp_replace(text, '[^0-9]', '', 'g')) > 40 * word_chars)
       AND NOT (100 * len(list_filter({_WORDS}, lambda x: NOT regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) > 50 * n_words)
       AND NOT (len(pa) >= 4 AND 100 * len(list_distinct(pa)) < 50 * len(pa)) AS kept
FROM failed
""",
)
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word, symbol and repetition counts of every document and the verdict of the rule cascade."""
    judged = rules.apply_rules(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *rules.COUNTS, "base_failed", "kept")


@register(
    "op8_source_mix",
    rf"""
WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size, md5('mix-1:' || doc_id) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS w FROM d GROUP BY source),
lv AS (SELECT *, CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (
                   ORDER BY source_size * 6 / w, source IS NULL, source
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
               / CAST(sum(w) OVER (ORDER BY source_size * 6 / w, source IS NULL, source
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level FROM s),
tg AS (SELECT *, least(CAST(3 * source_size AS DOUBLE), max(level) OVER () * w) AS target FROM lv),
r AS (SELECT doc_id, size, source_size, target,
             row_number() OVER (PARTITION BY d.source ORDER BY size, h, doc_id) - 1 AS pos,
             CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
             CAST(('0x' || substr(md5('mix-1:' || (CASE WHEN d.source IS NULL THEN '1' ELSE '0' END) || ':'
                                      || coalesce(d.source, '')), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN tg ON d.source IS NOT DISTINCT FROM tg.source)
SELECT doc_id, size, source_size, target,
       CAST(least(floor(rate * (pos + 1) + u) - floor(rate * pos + u), 3) AS BIGINT) * size AS taken
FROM r
""",
)
def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    docs = table(spark, sf_dir, "documents")
    # Texts are read once, to be counted.
    narrow = stored(docs.select("doc_id", "source", mixing.size_of(F.col("text")).alias("n_words")), "sizes")
    counted = mixing.mix_counts(narrow, sized_by="n_words")
    return counted.select("doc_id", "size", "source_size", "target", "taken")


@register(
    "op7_chat_windows",
    r"""
WITH t AS (SELECT conv_id, coalesce(turn, -4611686018427387904) AS turn, coalesce(role, '') AS role,
                  coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
p AS (SELECT *, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 2 AS tokens,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos FROM t),
b AS (SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY pos) - tokens AS begin,
             9 + length(regexp_replace(role, '([\\\[\]<])', '\\\1', 'g'))
               + length(regexp_replace(text, '([\\\[\]<])', '\\\1', 'g')) AS chars FROM p),
w AS (SELECT *, begin // 1024 AS win FROM b),
st AS (SELECT conv_id, win, min(begin) AS start FROM w GROUP BY ALL),
sy AS (SELECT conv_id, min(pos) AS spos, min_by(win, pos) AS swin, min_by(chars, pos) AS schars
       FROM w WHERE role = 'system' GROUP BY conv_id),
hi AS (SELECT w.conv_id, sum(chars) AS chars FROM w JOIN st ON st.conv_id = w.conv_id AND st.win = w.win + 1
       LEFT JOIN sy ON sy.conv_id = w.conv_id
       WHERE st.start - begin <= 256 AND pos IS DISTINCT FROM spos GROUP BY ALL),
sk AS (SELECT conv_id, sum(schars) AS chars FROM st JOIN sy USING (conv_id) WHERE win > swin GROUP BY ALL),
own AS (SELECT conv_id, count(*) AS n_turns, sum(chars) AS chars,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
               coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '') AS learnt
        FROM w GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, CAST(length(learnt) AS BIGINT) AS loss_chars, sha256(learnt) AS loss_sha256,
       CAST(own.chars + coalesce(hi.chars, 0) + coalesce(sk.chars, 0) AS BIGINT) AS formatted_chars
FROM own LEFT JOIN hi USING (conv_id) LEFT JOIN sk USING (conv_id)
""",
)
def op7_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations formatted in windows and read back from them."""
    ok = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(ok).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.windows(turns))


@register("op2_quality_classifier")
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; fold 2 of four is never learnt from, fold 3 calibrates."""
    docs, fold = table(spark, sf_dir, "documents"), quality.fold_of(F.col("doc_id"), 4)
    model = quality.fit(docs, table(spark, sf_dir, "labels"), fold != 2, fold == 3)
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (fold == 2).alias("held_out"), "score", "predicted")


@register("op5_secret_scan")
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.fit(docs), keep_text=False)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")


@register("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; fold 1 of three is never learnt from."""
    docs, fold = table(spark, sf_dir, "documents"), quality.fold_of(F.col("doc_id"), 3)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold != 1)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (fold == 1).alias("held_out"), "score", "predicted")


@register("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


@register("op1_embedding_forest")
def op1_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all embeddings."""
    return rp_forest.near_duplicates(table(spark, sf_dir, "embeddings"))


@register("op10_ngram_join")
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose five-word shingle sets are at least 80 per cent similar."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


_TERMS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)


@register(
    "op11_lexical_search",
    rf"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
st AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS length FROM d WHERE len(w) > 0),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
it AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
s AS (SELECT item_id, doc_id,
             CAST(sum(CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT)
                      * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // length)))) AS BIGINT) AS score
      FROM it JOIN df USING (term) JOIN tf USING (term), st GROUP BY item_id, doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
      FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 10
""",
)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    index = max_sketch.build_index(table(spark, sf_dir, "documents"))
    return max_sketch.search(index, table(spark, sf_dir, "benchmark"))


def repeated(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``, where one document in ten repeats itself from some word on.

    With n words, h = crc32(doc_id) and g = h div 10: if h mod 10 = 0, each word i >= a becomes word a + (i - a) mod p,
    where a = g mod n and p = 1 + (n - a) div (3 + g mod 8).
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def looped(words):
        n = F.size(words).cast("bigint")
        a = F.pmod(g, n)
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
        picked = F.transform(
            F.sequence(F.lit(0).cast("bigint"), n - 1),
            lambda i: F.get(words, F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")),
        )
        return F.when(n > 0, F.array_join(picked, " ")).otherwise("")

    changed = F.get(F.transform(F.array(words_of(F.col("text"))), looped), 0)
    return docs.select("doc_id", F.when(F.pmod(h, F.lit(10)) == 0, changed).otherwise(F.col("text")).alias("text"))


@register("op12_period_runs")
def op12_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repetitions of every document, the longest of them, and digests of all and of what is left without them."""
    found = period_runs.find_runs(repeated(table(spark, sf_dir, "documents")), keep_text=False)
    ranked = F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"], r["length"].alias("length")))
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    rows = found.select("doc_id", "runs", "collapsed", F.array_min(ranked).alias("longest"))
    return rows.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("longest.start").alias("start"),
        F.col("longest.length").alias("length"),
        F.col("longest.period").alias("period"),
        F.floor(F.lit(1000) * F.col("longest.length") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@register("op13_bpe_round_trip")
def op13_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the text that they decode to."""
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    decoded = bpe.decode(encoded)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


_TEMPLATE_ROWS = ", ".join(f"({k}, '{name}', '{notice}')" for k, (name, notice) in enumerate(license_scan.TEMPLATES))


@register(
    "op3_license_scan",
    rf"""
WITH d AS (SELECT doc_id, coalesce(source, '-') || '/' || coalesce(lang, '-') AS dir, coalesce(source, '-') AS top,
                  coalesce(text, '') AS text, len({_WORDS}) <= 60 AS short FROM documents),
l AS (SELECT * FROM (SELECT doc_id, dir, short, unnest(string_split(regexp_replace(text, '([.!?])\x20+', '\1' || chr(10), 'g'), chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '(?i)licen[cs]e|copyright|spdx')),
n AS (SELECT count(*) AS total FROM l),
tf AS (SELECT doc_id, dir, short, line, term, count(*) AS tf
       FROM (SELECT row_number() OVER () AS r, *, unnest(regexp_extract_all(lower(line), '[a-z0-9]+')) AS term FROM (SELECT DISTINCT * FROM l))
       GROUP BY ALL),
dl AS (SELECT line, count(*) AS times FROM l GROUP BY line),
lt AS (SELECT line, term, any_value(tf) AS tf FROM tf GROUP BY ALL),
df AS (SELECT term, sum(times) AS df FROM lt JOIN dl USING (line) GROUP BY term),
tp AS (SELECT k, license, term, count(*) AS tf FROM (
         SELECT k, license, unnest(regexp_extract_all(lower(notice), '[a-z0-9]+')) AS term
         FROM (VALUES {_TEMPLATE_ROWS}) AS v(k, license, notice)) GROUP BY ALL),
tw AS (SELECT k, license, term, tf * (ln((1 + total) / (1 + coalesce(df, 0))) + 1) AS w FROM tp LEFT JOIN df USING (term), n),
lw AS (SELECT line, term, tf * (ln((1 + total) / (1 + df)) + 1) AS w FROM lt JOIN df USING (term), n),
tn AS (SELECT k, sqrt(sum(w * w)) AS norm FROM tw GROUP BY k),
ln_ AS (SELECT line, sqrt(sum(w * w)) AS norm FROM lw GROUP BY line),
cs AS (SELECT lw.line, license, sum(lw.w * tw.w) / (any_value(tn.norm) * any_value(ln_.norm)) AS cosine
       FROM lw JOIN tw USING (term) JOIN tn USING (k) JOIN ln_ ON ln_.line = lw.line GROUP BY lw.line, k, license),
best AS (SELECT line, arg_min(license, (-round(cosine, 9), license)) AS license, max(cosine) AS cosine
         FROM cs GROUP BY line HAVING max(cosine) >= 0.6),
f AS (SELECT l.*, license, cosine FROM l JOIN best USING (line)),
own AS (SELECT doc_id, arg_min(license, (-round(cosine, 9), license)) AS license, max(cosine) AS cosine FROM f GROUP BY doc_id),
fd AS (SELECT dir, arg_min(license, (-round(cosine, 9), license, dir || '/' || doc_id)) AS license FROM f WHERE short GROUP BY dir)
SELECT d.doc_id, own.license, round(own.cosine, 4) AS cosine,
       CASE WHEN own.license IS NULL THEN fd.license END AS inherited,
       CASE WHEN own.license IS NULL AND fd.license IS NOT NULL THEN d.dir END AS inherited_from
FROM d LEFT JOIN own USING (doc_id) LEFT JOIN fd ON fd.dir = d.dir
""",
)
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, its own or its directory's; a document's path is source/lang/doc_id.

    Such a path names no file, so texts of at most ``FILE_WORDS`` words with a notice are licence files as well.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    folder = [F.coalesce(F.col(c), F.lit("-")) for c in ("source", "lang")]
    found = license_scan.scan(docs, "doc_id", F.concat_ws("/", *folder, F.col("doc_id").cast("string")), short_words=license_scan.FILE_WORDS)
    return found.select("doc_id", "license", F.round("cosine", 4).alias("cosine"), "inherited", "inherited_from")
