"""One query for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import Row, functions as F

from ..session import cut
from . import bpe, chat, codes, fingerprint, infill, langid, licenses, mixing, personal, quality, toxicity, vectors
from .ngram_join import jaccard_classes
from .registry import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]


@query("op1_multiset_fingerprint")
def op1(spark, sf_dir):
    return fingerprint.compare_with_next(table(spark, sf_dir, "documents"))


@query("op6_ngram_jaccard_join", r"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x20\x09-\x0D]+') AS ws FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)]
                                              WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY 1, 2),
    e AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100*shared >= 80*(na.n + nb.n - shared)),
    l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
    r(doc_id, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.seen)
    SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(seen) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id""")
def op6(spark, sf_dir):
    return jaccard_classes(table(spark, sf_dir, "documents"))


CHAT_EXTRA = "</s>[INST] ok [/INST]"


@query("op2_weak_supervision")
def op2(spark, sf_dir):
    figured = cut(quality.figures(table(spark, sf_dir, "documents"), keep=["doc_id"]))
    failed = quality.base_failed()
    return (quality.judge(figured)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"), (~failed & F.col("good")).alias("kept"), "quality"))


@query("op3_chat_format", f"""
    WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -7, 0, 'user', '{CHAT_EXTRA}' UNION ALL SELECT -7, 1, 'assistant', '{CHAT_EXTRA}'),
    m AS (SELECT *, replace(replace(text, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|') AS esc,
                 role = lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS same FROM t)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(length(esc) + CASE WHEN same THEN 8 ELSE length(role) + 16 + 7 END)
                AS BIGINT) AS formatted_chars
    FROM m GROUP BY conv_id""")
def op3(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([Row(conv_id=-7, turn=0, role="user", text=CHAT_EXTRA),
                                   Row(conv_id=-7, turn=1, role="assistant", text=CHAT_EXTRA)], turns.schema)
    return chat.digest(chat.format_conversations(turns.union(extra)))


@query("op4_license_scan")
def op4(spark, sf_dir):
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


@query("op5_curriculum_mixing", r"""
    WITH d AS (SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size, md5(text) AS m FROM documents),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5e0 WHEN 1 THEN 2e0 ELSE 1e0 END AS w
          FROM d GROUP BY source),
    r AS (SELECT *, 2e0*source_size AS lim, 1.5e0*(SELECT sum(source_size) FROM s) AS total FROM s),
    k AS (SELECT *, (total - coalesce(sum(lim) OVER (ORDER BY lim/w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0))
                    / sum(w) OVER (ORDER BY lim/w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
    l AS (SELECT level FROM k WHERE lim/w > level ORDER BY lim/w, source LIMIT 1),
    t AS (SELECT source, source_size, least(w*coalesce((SELECT level FROM l), 1e300), lim) AS target FROM r),
    n AS (SELECT source, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS nth FROM s),
    p AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target, n.nth, CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('0/' || d.doc_id), d.doc_id, d.size, d.m
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source JOIN n ON n.source IS NOT DISTINCT FROM d.source),
    q AS (SELECT *, CAST(greatest(least(size, floor(target) - place), 0) + greatest(least(size, floor(target) - place - source_size), 0) AS BIGINT) AS taken,
             place / greatest(target, 1e0) AS u FROM p)
    SELECT doc_id, source, CAST(size AS BIGINT) AS size, source_size, target, place, taken, round(CASE WHEN taken > 0 THEN least(CASE nth
             WHEN 0 THEN CASE WHEN u >= 7.5e-1 THEN 5e-1 + (u - 7.5e-1)/5e-1 ELSE u/1.5e0 END WHEN 1 THEN u
             ELSE CASE WHEN u >= 2.5e-1 THEN 5e-1 + (u - 2.5e-1)/1.5e0 ELSE u/5e-1 END END, 1e0) END, 9) AS position FROM q""")
def op5(spark, sf_dir):
    return mixing.curriculum(cut(mixing.line_up(table(spark, sf_dir, "documents")))).withColumn("position", F.round("position", 9))


@query("op7_bpe_encode_decode")
def op7(spark, sf_dir):
    return bpe.digest(table(spark, sf_dir, "documents"))


@query("op8_addressable_token_codes")
def op8(spark, sf_dir):
    folder = codes.fresh_folder(spark)
    codes.write(table(spark, sf_dir, "documents"), folder)
    return codes.digest(spark, folder)


@query("op9_toxicity_deobfuscation")
def op9(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = toxicity.fit(docs, labels.where(fold != 0))
    scored = toxicity.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", (F.coalesce(fold, F.lit(0)) == 0).alias("held_out"), "score", "predicted")


@query("op10_language_id")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = langid.fit(docs.where(fold != 1))
    found = langid.predict(docs, model, keep=["doc_id"])
    return found.select("doc_id", (F.coalesce(fold, F.lit(1)) == 1).alias("held_out"), "lang_pred", "score", "rejected")


@query("op11_pii_boosting")
def op11(spark, sf_dir):
    return personal.digest(table(spark, sf_dir, "documents"))


_DIST = "list_sum(list_transform(range(1, len(p.part) + 1), lambda k: (p.part[k] - c.part[k]) * (p.part[k] - c.part[k])))"


def _assign(books: str) -> str:
    """Nearest entry of every part, as [distance, entry]."""
    return f"""SELECT p.row, p.pos, any_value(p.part) AS part, min([{_DIST}, c.e]) AS m FROM p JOIN {books} c ON c.pos = p.pos GROUP BY p.row, p.pos"""


def _renew(books: str, found: str) -> str:
    """Entries replaced by the floor of the mean of their parts."""
    return f"""SELECT c.pos, c.e, coalesce(u.part, c.part) AS part FROM {books} c LEFT JOIN
        (SELECT pos, e, list((s - ((s % n) + n) % n) // n ORDER BY k) AS part FROM
            (SELECT pos, m[2] AS e, k, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM
                (SELECT pos, m, unnest(part) AS x, unnest(range(len(part))) AS k FROM {found}) GROUP BY ALL) GROUP BY pos, e) u ON u.pos = c.pos AND u.e = c.e"""


@query("op12_vector_trie_codes", f"""
    WITH k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
                            FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    p AS MATERIALIZED (SELECT row, pos, v[pos * (len(v) // 16) + 1 : (pos + 1) * (len(v) // 16)] AS part FROM k, (SELECT unnest(range(16)) AS pos)),
    c0 AS MATERIALIZED (SELECT pos, row - 1 AS e, part FROM p WHERE row <= 64),
    a1 AS MATERIALIZED ({_assign('c0')}), c1 AS MATERIALIZED ({_renew('c0', 'a1')}),
    a2 AS MATERIALIZED ({_assign('c1')}), c2 AS MATERIALIZED ({_renew('c1', 'a2')}),
    a3 AS MATERIALIZED ({_assign('c2')}),
    r AS (SELECT row, string_agg(printf('%02x', CAST(m[2] AS INTEGER)), '' ORDER BY pos) AS code, CAST(sum(m[1]) AS BIGINT) AS error FROM a3 GROUP BY row)
    SELECT k.vec_id, r.code, r.error, CAST(sum(r.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY pos, e)) FROM c2) AS codebooks_sha256
    FROM r JOIN k ON k.row = r.row""")
def op12(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    books = vectors.learn(rows)
    coded = cut(vectors.encode(rows, books, keep=["vec_id", "label"]))
    out = vectors.with_label_error(coded).select("vec_id", "code", "error", "label_error")
    return out.withColumn("codebooks_sha256", F.lit("" if books is None else vectors.codebook_sha256(books)))


@query("op13_fill_in_middle", r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
                      regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
    k AS (SELECT doc_id, text, u, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS b,
                 CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50
                      THEN 'plain' WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
    s AS (SELECT *, array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
                 array_to_string(u[greatest(a, b) + 1:n], '') AS s FROM k)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
           sha256(text) AS restored_sha256 FROM s""")
def op13(spark, sf_dir):
    return infill.digest(table(spark, sf_dir, "documents"))
