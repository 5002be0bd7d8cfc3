"""The driver's queries for the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm import archives, bpe, conversations, descent, fim, hnsw, langid, licenses, mixing, packing, secrets, simhash, tokenfiles

Query = Callable[[SparkSession, str], DataFrame]

#: The tokenizer of ops 3 and 10, by its name among the public tokenizers.
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
#: The tokenizer of op 11.
WORD_TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def held_out(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0


def op1_licenses(spark, sf):
    found = licenses.scan(_table(spark, sf, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    joined = [F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",") for spans in (base, F.col("spans"))]
    firsts = F.transform(base, lambda s: s["first"].cast("bigint"))
    return found.select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(firsts).alias("first_word"),
        F.array_max(firsts).alias("last_word"),
        joined[0].alias("base_labels"),
        joined[1].alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"),
    )


def op2_language_id(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text", "lang")
    samples = langid.fit(docs.filter(~held_out()))
    found = langid.identify(docs.drop("lang"), samples, drop_text=True)
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "bits")


def op3_token_files(spark, sf):
    read = tokenfiles.token_files(_table(spark, sf, "documents"), tokenizer_path(), END_ID)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_near_vectors(spark, sf):
    return descent.near_vectors(_table(spark, sf, "embeddings"), 0.93)


def op5_mixing(spark, sf):
    mixed = mixing.mix(_table(spark, sf, "documents"), F.array("source"))
    return mixed.select(
        "doc_id", "size", F.col("source_sizes")[0].alias("source_size"), F.col("targets")[0].alias("target"), "taken"
    )


def op6_simhash(spark, sf):
    near = simhash.near_duplicates(_table(spark, sf, "documents"), words=3, radius=2)
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_neighbours(spark, sf):
    return hnsw.nearest(_table(spark, sf, "embeddings"), lambda i: i % 100 == 0, k=10)


def op8_archives(spark, sf):
    read = archives.archived(_table(spark, sf, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_secrets(spark, sf):
    found = secrets.find_secrets(_table(spark, sf, "documents"))
    spans = F.col("spans")
    counts = [secrets.count_of(spans, kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    digest = F.sha2(secrets.joined(spans, base_only=True).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, secrets.joined(spans, base_only=False).alias("spans"))


def op10_bpe(spark, sf):
    coded = bpe.encode(_table(spark, sf, "documents"), tokenizer_path(), decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op11_packing(spark, sf):
    cut = packing.write_pieces(_table(spark, sf, "documents"), tokenizer_path(WORD_TOKENIZER))
    digests = cut.select("key", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.packed(digests)


def op12_fill_in_middle(spark, sf):
    made = fim.transform(_table(spark, sf, "documents"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    back = fim.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(back).alias("restored_sha256")
    )


def op13_conversations(spark, sf):
    rows = _table(spark, sf, "conversations")
    return conversations.with_untouched(conversations.repair(conversations.damaged(rows)), rows)


def queries() -> dict[str, Query]:
    return {
        "op1_licenses": op1_licenses,
        "op2_language_id": op2_language_id,
        "op3_token_files": op3_token_files,
        "op4_near_vectors": op4_near_vectors,
        "op5_mixing": op5_mixing,
        "op6_simhash": op6_simhash,
        "op7_neighbours": op7_neighbours,
        "op8_archives": op8_archives,
        "op9_secrets": op9_secrets,
        "op10_bpe": op10_bpe,
        "op11_packing": op11_packing,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_conversations": op13_conversations,
    }


_PAYLOADS = "payloads AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages)"


_TOKENS = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
_FIM = (
    "WITH hashed AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h FROM documents), "
    f"cut AS (SELECT *, regexp_extract_all(text, '{_TOKENS}') AS tokens, "
    + ", ".join(f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT) AS h{k + 1}" for k in range(4))
    + " FROM hashed), formed AS (SELECT *, len(tokens) AS n, "
    "CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' "
    "WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM cut), "
    "placed AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM formed), "
    "parts AS (SELECT *, array_to_string(tokens[1:a], '') AS prefix, array_to_string(tokens[a + 1:b], '') AS middle, "
    "array_to_string(tokens[b + 1:], '') AS suffix FROM placed) "
    "SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, "
    "CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars, sha256(CASE form WHEN 'plain' THEN text "
    "WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, "
    "sha256(text) AS restored_sha256 FROM parts"
)

# Costs by state (0 nothing, 1 after s, 2 after u, 3 after a) go forward row by row, with the
# letters and lines of the best way to each state.
_SAME = "IS NOT DISTINCT FROM"
_CRC32 = (
    "xor(list_reduce(list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda c, b: "
    "list_reduce([1, 1, 1, 1, 1, 1, 1, 1], lambda r, k: xor(r >> 1, (r & 1) * CAST(3988292384 AS BIGINT)), xor(c, b)), CAST(4294967295 AS BIGINT)), 4294967295)"
)
_REPAIR = (
    "WITH RECURSIVE keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, "
    "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations), "
    f"marked AS (SELECT *, {_CRC32} % 20 AS kind FROM keyed), "
    "damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, "
    "CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text, "
    "unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM marked WHERE kind <> 0), "
    "placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos, left(role, 1) AS initial, "
    "rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed FROM damaged), "
    "faults AS (SELECT *, CASE WHEN trimmed = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate' "
    "WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, "
    "lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair FROM placed), "
    "counts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, "
    "count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, "
    "count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id), "
    "inserted(s, t, c, letters, lines) AS (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''), "
    "(0, 2, 2, 'I', 'user:' || chr(10)), (1, 2, 2, 'I', 'user:' || chr(10)), (3, 2, 2, 'I', 'user:' || chr(10)), (2, 3, 2, 'I', 'assistant:' || chr(10)), "
    "(0, 3, 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)), (1, 3, 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10))), "
    "done(s, t, letter, c, initial, name) AS (VALUES (0, 0, 'D', 3, NULL, NULL), (1, 1, 'D', 3, NULL, NULL), (2, 2, 'D', 3, NULL, NULL), (3, 3, 'D', 3, NULL, NULL), "
    "(0, 1, 'K', 0, 's', NULL), (0, 2, 'K', 0, 'u', NULL), (1, 2, 'K', 0, 'u', NULL), (3, 2, 'K', 0, 'u', NULL), (2, 3, 'K', 0, 'a', NULL), "
    "(0, 2, 'R', 2, NULL, 'user'), (1, 2, 'R', 2, NULL, 'user'), (3, 2, 'R', 2, NULL, 'user'), (2, 3, 'R', 2, NULL, 'assistant')), "
    "walk AS (SELECT conv_id, CAST(0 AS BIGINT) AS pos, 0 AS state, {'cost': 0, 'audit': '', 'lines': ''} AS best FROM counts UNION ALL "
    "SELECT w.conv_id, w.pos + 1, d.t, min({'cost': w.best.cost + i.c + d.c + CASE WHEN d.letter <> 'D' AND f.fault = 'truncated' THEN 1 ELSE 0 END, "
    "'audit': w.best.audit || i.letters || d.letter, 'lines': w.best.lines || i.lines || CASE WHEN d.letter = 'D' THEN '' ELSE coalesce(d.name, f.role) || ':' || f.text || chr(10) END}) "
    f"FROM walk w JOIN faults f ON w.conv_id {_SAME} f.conv_id AND f.pos = w.pos + 1 JOIN inserted i ON i.s = w.state JOIN done d ON d.s = i.t "
    "WHERE (d.letter = 'D' OR f.fault NOT IN ('blank', 'duplicate')) AND (d.letter <> 'K' OR d.initial = f.initial) GROUP BY w.conv_id, w.pos, d.t), "
    "ends AS (SELECT w.conv_id, min({'cost': w.best.cost + i.c, 'audit': w.best.audit || i.letters, 'lines': w.best.lines || i.lines}) AS best "
    f"FROM walk w JOIN counts n ON w.conv_id {_SAME} n.conv_id AND w.pos = n.n JOIN inserted i ON i.s = w.state AND i.t IN (0, 3) GROUP BY w.conv_id) "
    "SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, "
    "coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost, coalesce(best.audit, '') AS audit, "
    "sha256(coalesce(left(best.lines, length(best.lines) - 1), '')) AS repaired_sha256 FROM (SELECT DISTINCT conv_id FROM conversations) o "
    f"LEFT JOIN counts n ON o.conv_id {_SAME} n.conv_id LEFT JOIN ends e ON o.conv_id {_SAME} e.conv_id"
)


def oracle_sql() -> dict[str, str]:
    return {
        "op12_fill_in_middle": _FIM,
        "op13_conversations": _REPAIR,
        "op4_near_vectors": (
            "WITH RECURSIVE good AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings "
            "WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 "
            "AND len(list_filter(embedding, lambda x: x <> 0)) > 0), "
            "links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id "
            "WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) >= 0.93), "
            "reached AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a), "
            "least AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a), "
            "degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a) "
            "SELECT e.vec_id AS vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept "
            "FROM embeddings e JOIN least ON e.vec_id = least.a LEFT JOIN degrees d ON e.vec_id = d.a"
        ),
        "op8_archives": (
            f"WITH {_PAYLOADS}, marked AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS payload_digest FROM payloads), "
            "held AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS holder FROM marked) "
            "SELECT page_id, payload_bytes, payload_digest, "
            "CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM holder THEN 'revisit' ELSE 'response' END AS record_type, "
            "CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM holder THEN holder END AS refers_to FROM held"
        ),
    }
