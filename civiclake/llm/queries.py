"""One registered query per operator, over whole tables, with production parameters.

SQL has the oracle of a query where SQL can express it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.llm import bpe, chat, collocations, decontam, html_text, jaccard, language, line_dedup, quality, resample, secrets, substring, token_orc
from civiclake.llm.common import table
from civiclake.session import shared_dir

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def tokenizer_file(name: str) -> str:
    """Content of a tokenizer file (read once on the driver; executors get it by broadcast)."""
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def op1_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "op1")
    token_orc.write_tokens(table(spark, sf_dir, "documents"), tokenizer_file(BYTE_BPE), path)
    return token_orc.token_digests(token_orc.read_tokens(spark, path))


def op2_secret_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.train(docs))
    kind = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")
    text = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    base = F.filter("found", lambda s: s["kind"] != secrets.CRF)
    return found.select(
        "doc_id", kind("assign").alias("n_assign"), kind("access").alias("n_access"), kind("hex").alias("n_hex"), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("found")).alias("spans")
    )


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(language.fold(F.col("doc_id")) == 2, F.lit(False))
    model = language.train(docs.where(F.col("doc_id").isNotNull() & ~held_out))
    return language.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_file(WORD_BPE))


def op5_quality_js(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeated(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        decontam.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    probe = "</s>[INST] ok [/INST]"
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(probe).alias("text"))
    read = chat.read_chats(chat.format_chats(chat.canonical_turns(given.unionByName(extra, allowMissingColumns=True))))
    loss = F.concat_ws("", "loss_texts")
    turns = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.remove_common_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_token_orc": op1_token_orc,
    "op2_secret_crf": op2_secret_crf,
    "op3_language": op3_language,
    "op4_bpe": op4_bpe,
    "op5_quality_js": op5_quality_js,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_decontaminate": op8_decontaminate,
    "op9_chat_format": op9_chat_format,
    "op10_html_text": op10_html_text,
    "op11_line_dedup": op11_line_dedup,
    "op12_collocations": op12_collocations,
    "op13_resample": op13_resample,
}

#: Words as the contract has them, and lower case of A-Z only.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _escaped(column: str) -> str:
    """The escaping of chat texts by plain replacements."""
    out = f"replace({column}, '\\', '\\\\')"
    for c in chat.CONTROLS:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


SQL: dict[str, str] = {
    "op6_substring_dedup": f"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT rn, i, list_slice(w, i, i + 34) AS x FROM (SELECT rn, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
dup AS (SELECT x FROM win GROUP BY x HAVING count(*) > 1),
gone AS (SELECT DISTINCT rn, unnest(range(i, i + 35)) AS pos FROM win SEMI JOIN dup USING (x)),
kept AS (SELECT rn, string_agg(word, ' ' ORDER BY pos) AS txt
  FROM (SELECT rn, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d) ANTI JOIN gone USING (rn, pos) GROUP BY rn),
n AS (SELECT rn, count(*) AS n FROM gone GROUP BY rn)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(txt, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rn) LEFT JOIN n USING (rn)""",
    "op7_jaccard_join": f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rn, doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT rn, list_slice(w, i, i + 4) AS x FROM (SELECT rn, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT rn, count(*) AS n FROM sh GROUP BY rn),
both_ AS (SELECT a.rn AS a, b.rn AS b, count(*) AS k FROM sh a JOIN sh b ON a.x = b.x AND a.rn <> b.rn GROUP BY ALL),
link AS (SELECT a, b FROM both_ JOIN n p ON p.rn = a JOIN n q ON q.rn = b WHERE 100 * k >= 75 * (p.n + q.n - k)),
reach(rn, other) AS (SELECT rn, rn FROM d UNION SELECT reach.rn, link.b FROM reach JOIN link ON link.a = reach.other),
least AS (SELECT reach.rn, min(o.doc_id) AS component_id FROM reach JOIN d o ON o.rn = reach.other GROUP BY reach.rn)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM d LEFT JOIN n USING (rn) JOIN least USING (rn)""",
    "op8_decontaminate": f"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item, list_slice(w, i, i + 12) AS x FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 11, 2))) AS i FROM b WHERE len(w) > 0)),
size AS (SELECT DISTINCT len(x) AS k FROM win),
seen AS (SELECT rn, i, k, list_slice(w, i, i + k - 1) AS x FROM (SELECT rn, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, size WHERE len(w) >= k)),
hit AS (SELECT rn, i, k, item FROM seen JOIN win USING (x)),
words AS (SELECT rn, count(*) AS n_hit FROM (SELECT DISTINCT rn, unnest(range(i, i + k)) FROM hit) GROUP BY rn),
items AS (SELECT rn, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY rn)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (rn) LEFT JOIN items USING (rn)""",
    "op9_chat_format": f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS txt FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || txt || chr(10), '' ORDER BY turn NULLS FIRST, role, txt) AS turns,
  coalesce(string_agg(txt, '' ORDER BY turn NULLS FIRST, txt) FILTER (WHERE role = 'assistant'), '') AS loss,
  sum({len(chat.TURN) + 1 + len(chat.END)} + length(replace({_escaped("role")}, chr(10), '\\' || chr(10))) + length({_escaped("txt")})) AS formatted_chars
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(formatted_chars AS BIGINT) AS formatted_chars FROM g""",
    "op11_line_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT rn, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM x),
bad AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rn) >= 10),
kept AS (SELECT rn, string_agg(line, chr(10) ORDER BY pos) AS txt, count(*) AS n FROM k ANTI JOIN bad USING (key) GROUP BY rn)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_lines, len(l) - coalesce(n, 0) AS n_dropped, sha256(coalesce(txt, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (rn)""",
    "op12_collocations": f"""
WITH d AS (SELECT row_number() OVER () AS rn, coalesce(lang, 'und') AS lang, regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]') AS p FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(p), '[^\\x20\\x09]+') AS w FROM d),
tot AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: list_slice(w, i, i + k - 1))) AS x FROM p, range(1, 5) r(k) WHERE len(w) >= k),
f AS (SELECT lang, x, any_value(k) AS k, count(*) AS f FROM g GROUP BY lang, x HAVING count(*) >= 30),
cut AS (SELECT lang, x, k, f AS a, unnest(range(1, k)) AS c FROM f WHERE k > 1),
sc AS (SELECT cut.lang, cut.x, cut.a, c, p.f AS l, q.f AS r, CAST(2000000::HUGEINT * cut.a // (p.f + q.f) AS BIGINT) AS score FROM cut
  JOIN f p ON p.lang = cut.lang AND p.x = list_slice(cut.x, 1, c) JOIN f q ON q.lang = cut.lang AND q.x = list_slice(cut.x, c + 1, cut.k)),
best AS (SELECT lang, x, a, unnest(min(struct_pack(score := score, c := c, l := l, r := r))) FROM (SELECT lang, x, a, score, c, l, r FROM sc) GROUP BY lang, x, a),
sub AS (SELECT lang, list_slice(x, i, i + m - 1) AS x, max(f) AS around FROM (SELECT lang, x, k, f, m, unnest(range(1, k - m + 2)) AS i FROM f, range(2, 4) s(m) WHERE m < k) GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN sub USING (lang, x) WHERE around IS NULL OR 100 * around < 80 * a),
r AS (SELECT *, array_to_string(x, ' ') AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(x, ' ')) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r.r, n, score FROM r JOIN tot USING (lang) WHERE rank <= 2000""",
    "op13_resample": f"""
WITH tab AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab FROM range(256) r(i)),
src AS (SELECT 'd' AS side, row_number() OVER () AS rn, doc_id, text FROM documents UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark),
d AS (SELECT side, rn, doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM src),
f AS (SELECT side, rn, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM d),
u AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM f)),
c AS (SELECT f, xor(list_reduce([4294967295] || list_transform(range(0, strlen(f)), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
  lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM u, tab),
fb AS (SELECT side, rn, bucket FROM f JOIN c USING (f)),
n AS (SELECT bucket, count(*) FILTER (WHERE side = 'd') AS s, count(*) FILTER (WHERE side = 'b') AS t FROM fb GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE))) AS BIGINT) AS gain FROM n),
wt AS (SELECT rn, count(*) AS n_features, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight FROM fb JOIN g USING (bucket) WHERE side = 'd' GROUP BY rn),
sc AS (SELECT rn, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
  (CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5)::DOUBLE / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN wt USING (rn) WHERE side = 'd'),
r AS (SELECT rn, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM sc WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank FROM sc LEFT JOIN r USING (rn)""",
}
