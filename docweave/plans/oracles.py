"""The registered queries as SQL for DuckDB, over the same Parquet tables.

A NULL column of the joined tables stands for a missing metadata key."""

from __future__ import annotations

from docweave.operators.fulltext import B, K1, SCALE
from docweave.plans.testbed import DIMENSION, WORDS

TOKENS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+')"

COLL = """coll AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS _id, d.text AS document, e.embedding, d.lang, d.source,
         d.n_chars, CAST(l.quality AS BIGINT) AS quality, CAST(l.toxic AS BIGINT) AS toxic
  FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id
  LEFT JOIN labels l ON l.doc_id = d.doc_id)"""

VECTORS = """queries AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings)"""


def tokens(column: str) -> str:
    return TOKENS.format(column)


def contains(words: str, column: str = "document") -> str:
    listed = ", ".join(f"'{w}'" for w in words.split())
    return f"list_has_any({tokens(column)}, [{listed}])"


def simple(columns: str, predicate: str = "TRUE", source: str = "coll") -> str:
    return f"WITH {COLL} SELECT {columns} FROM {source} WHERE {predicate}"


def events(predicate: str) -> str:
    return f"""SELECT CAST(event_id AS VARCHAR) AS _id FROM events
               WHERE CAST(json_extract(props, '$.k') AS BIGINT) {predicate}"""


def hashed(name: str, source: str) -> str:
    """CTEs that give `name(id, vector)`, hash vectors of `source(id, text)`."""
    return f"""{name}_counts AS (
      SELECT id, CAST(concat('0x', substr(md5(token), 1, 8)) AS BIGINT) % {DIMENSION} AS bucket,
             count(*) AS n
      FROM (SELECT id, unnest({tokens('text')}) AS token FROM ({source})) GROUP BY ALL),
    {name}_norms AS (SELECT id, sqrt(sum(n * n)) AS norm FROM {name}_counts GROUP BY id),
    {name}_cells AS (
      SELECT s.id, b.bucket, CAST(coalesce(c.n / m.norm, 0) AS FLOAT) AS value
      FROM ({source}) s CROSS JOIN (SELECT unnest(range({DIMENSION})) AS bucket) b
      LEFT JOIN {name}_counts c ON c.id = s.id AND c.bucket = b.bucket
      LEFT JOIN {name}_norms m ON m.id = s.id),
    {name} AS (SELECT id, list(CAST(value AS DOUBLE) ORDER BY bucket) AS vector
               FROM {name}_cells GROUP BY id)"""


HASHED_COLL = hashed("doc_vectors", "SELECT CAST(doc_id AS VARCHAR) AS id, text FROM documents")
HASHED_QUERIES = hashed("query_vectors", "SELECT item_id AS id, text FROM benchmark")
HASHED = f"""{COLL}, {HASHED_COLL}, {HASHED_QUERIES},
  hashed_coll AS (SELECT coll.* EXCLUDE (embedding), vector AS embedding
                  FROM coll JOIN doc_vectors ON id = _id),
  queries AS (SELECT id AS query_id, vector FROM query_vectors)"""

DISTANCE = {
    "l2": "list_distance", "cosine": "list_cosine_distance", "inner_product": "list_inner_product",
    "negative": "-list_inner_product",
}


def knn(k: int, distance: str, predicate: str = "TRUE", source: str = "coll") -> str:
    """`(query_id, rank, _id, distance)` for the CTEs `queries` and `source`."""
    return f"""SELECT * FROM (
      SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, _id) AS rank,
             _id, distance
      FROM (SELECT query_id, _id,
                   {DISTANCE[distance]}(CAST(embedding AS DOUBLE[]), vector) AS distance
            FROM queries CROSS JOIN {source}
            WHERE embedding IS NOT NULL AND ({predicate}))
      WHERE distance IS NOT NULL AND NOT isnan(distance)) WHERE rank <= {k}"""


KNN_COLUMNS = "query_id, rank, _id, round(distance, 6) + 0.0 AS distance"


def knn_query(k: int, distance: str, predicate: str = "TRUE") -> str:
    return f"WITH {COLL}, {VECTORS} SELECT {KNN_COLUMNS} FROM ({knn(k, distance, predicate)})"


def bm25(k: int, words: str, predicate: str = "TRUE") -> str:
    """CTEs up to `scored(query_id, rank, _id, score)`; `words` gives `(query_id, text)`."""
    return f"""
    words AS (SELECT DISTINCT query_id, unnest({tokens('text')}) AS token FROM ({words})),
    doc_tokens AS (SELECT _id, {tokens('document')} AS listed FROM coll),
    corpus AS (SELECT count(listed) AS n, avg(len(listed)) AS mean_len FROM doc_tokens),
    term_counts AS (
      SELECT _id, doc_len, token, count(*) AS tf
      FROM (SELECT _id, len(listed) AS doc_len, unnest(listed) AS token FROM doc_tokens)
      WHERE token IN (SELECT token FROM words) GROUP BY ALL),
    rarity AS (SELECT token, ln(1 + (any_value(n) - count(*) + 0.5) / (count(*) + 0.5)) AS idf
               FROM term_counts CROSS JOIN corpus GROUP BY token),
    parts AS (
      SELECT query_id, t._id, CAST(floor(
        idf * (tf * {K1 + 1}) / (tf + {K1} * ({1 - B} + {B} * doc_len / mean_len)) * {SCALE}.0 + 0.5
      ) AS BIGINT) AS part
      FROM words JOIN rarity USING (token) JOIN term_counts t USING (token) CROSS JOIN corpus
      JOIN coll c ON c._id = t._id WHERE {predicate}),
    scored AS (
      SELECT * FROM (
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY total DESC, _id) AS rank,
               _id, total / {SCALE}.0 AS score
        FROM (SELECT query_id, _id, sum(part) AS total FROM parts GROUP BY ALL)) WHERE rank <= {k})"""


def one(words: str) -> str:
    return f"SELECT CAST(0 AS BIGINT) AS query_id, '{words}' AS text"


SCORED_COLUMNS = "query_id, rank, _id, round(score, 6) + 0.0 AS score"


def fused(k: int, window: int, constant: int, distance_hits: str, own_texts: bool = False) -> str:
    """Fusion of the CTE `scored` (one text list for all queries, or one for each) with vector hits."""
    source = "scored s" if own_texts else "queries q CROSS JOIN scored s"
    query_id = "s.query_id" if own_texts else "q.query_id"
    return f"""
    near AS ({distance_hits}),
    texts AS (SELECT {query_id}, s._id, s.rank, s.score FROM {source}
              WHERE s.rank <= {window}),
    fused AS (
      SELECT coalesce(t.query_id, v.query_id) AS query_id, coalesce(t._id, v._id) AS _id, score,
             distance, coalesce(1.0::DOUBLE / ({constant} + t.rank), 0)
                       + coalesce(1.0::DOUBLE / ({constant} + v.rank), 0) AS fused_score
      FROM texts t FULL JOIN (SELECT * FROM near WHERE rank <= {window}) v
        ON t.query_id = v.query_id AND t._id = v._id)
    SELECT * FROM (
      SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY fused_score DESC, _id) AS rank,
             _id, round(distance, 6) + 0.0 AS distance, round(score, 6) + 0.0 AS score,
             round(fused_score, 6) + 0.0 AS fused_score
      FROM fused) WHERE rank <= {k}"""


def flat(embedding: str = "embedding") -> str:
    """Columns of `flat` over a source with embedding, lang, n_chars, quality, label."""
    return f"""_id, document, len({embedding}) AS n_dims,
      round(list_sum(CAST({embedding} AS DOUBLE[])), 6) + 0.0 AS vector_sum,
      lang, n_chars, quality, label"""


OLD = f"{COLL}, old AS (SELECT *, CAST(NULL AS BIGINT) AS label FROM coll)"


def merged(changes: str, given: tuple[str, ...], insert: bool) -> str:
    """Old rows changed by the CTE `changes`; `given` are its columns besides `_id`."""
    metadata = ("lang", "n_chars", "quality", "label")
    columns = []
    for c in ("document", "embedding", *metadata):
        if c in metadata and "metadata" in given:
            new = f"c.{c}" if c in given else "NULL"
            columns.append(f"CASE WHEN c._id IS NOT NULL THEN {new} ELSE o.{c} END AS {c}")
        elif c in given:
            columns.append(f"coalesce(c.{c}, o.{c}) AS {c}")
        else:
            columns.append(f"o.{c}")
    if "document" not in given:
        columns[0] = "CASE WHEN o._id IS NULL THEN '' ELSE o.document END AS document"
    side = "FULL" if insert else "LEFT"
    return f"""WITH {OLD}, changes AS ({changes}), new AS (
      SELECT coalesce(o._id, c._id) AS _id, {', '.join(columns)}
      FROM old o {side} JOIN changes c ON c._id = o._id)
      SELECT {flat()} FROM new"""


CONVERSATION_ROWS = "SELECT concat('c-', conv_id, '-', turn) AS id, text FROM conversations"
NO_METADATA = """CAST(NULL AS VARCHAR) AS lang, CAST(NULL AS BIGINT) AS n_chars,
                 CAST(NULL AS BIGINT) AS quality, CAST(NULL AS BIGINT) AS label"""

SIMPLE_TEXT = bm25(10, one(WORDS), "lang = 'en'")

SQL = {
    "include_default": simple("_id, document, lang, n_chars"),
    "include_none": simple("_id"),
    "metadata_text": simple("""_id, concat('{', array_to_string(list_filter([
        '"lang":"' || lang || '"', '"n_chars":' || n_chars, '"quality":' || quality,
        '"source":"' || source || '"', '"toxic":' || toxic], lambda x: x IS NOT NULL), ','), '}')
        AS metadata"""),
    "parse_vector": """SELECT vec_id, pos - 1 AS pos, round(CAST(embedding[pos] AS DOUBLE), 6) AS value
        FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)""",
    "parse_metadata": """SELECT CAST(event_id AS VARCHAR) AS _id,
        CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
    "id_bytes": "SELECT doc_id, text AS decoded FROM documents",

    "filter_eq": simple("_id", "lang = 'en'"),
    "filter_ne_missing": simple("_id", "quality <> 1"),
    "filter_gt": events("> 50"),
    "filter_gte": simple("_id", "n_chars >= 2000"),
    "filter_lt": events("< 9.5"),
    "filter_lte": simple("_id", "n_chars <= 500"),
    "filter_in": simple("_id", "lang IN ('de', 'fr')"),
    "filter_nin_missing": simple("_id", "quality NOT IN (0)"),
    "filter_in_table": simple("_id", """source IN (SELECT d.source FROM documents d
        JOIN labels l ON l.doc_id = d.doc_id WHERE l.toxic = 1)"""),
    "filter_in_table_numbers": """SELECT CAST(event_id AS VARCHAR) AS _id FROM events
        WHERE CAST(json_extract_string(props, '$.k') AS DOUBLE) IN (
            SELECT CAST(l_quantity AS DOUBLE) FROM lineitem WHERE l_returnflag = 'R' AND l_discount > 0.05)""",
    "get_deep_page": """SELECT CAST(event_id AS VARCHAR) AS _id FROM events
        ORDER BY _id LIMIT 50 OFFSET 5000""",
    "filter_nin_table": simple("_id", """source NOT IN (SELECT d.source FROM documents d
        JOIN labels l ON l.doc_id = d.doc_id WHERE l.toxic = 1)"""),
    "filter_and": simple("_id", "lang = 'en' AND quality = 1 AND n_chars > 1000"),
    "filter_or": simple("_id", "lang = 'de' OR toxic = 1"),
    "filter_not_missing": simple("_id", "NOT (quality = 0 OR n_chars < 300)"),
    "filter_nested_path": simple("_id", "lang = 'fr' AND n_chars >= 1000"),
    "filter_ids": simple("_id", "_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE quality = 1)"),
    "filter_combined": simple("_id", f"""_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)
        AND lang = 'en' AND n_chars > 800 AND {contains('license copyright')}"""),

    "doc_contains": simple("_id", contains(WORDS)),
    "doc_regex": simple("_id", "regexp_matches(document, '[0-9]{3}-[0-9]{3,4}')"),
    "doc_and": simple("_id", f"""{contains('the und')}
        AND regexp_matches(document, '(?i)licen[cs]e|apache')"""),
    "doc_or": simple("_id", f"""{contains('und')}
        OR ({contains('les')} AND regexp_matches(document, '^[A-Z]'))"""),
    "postings": f"""WITH {COLL} SELECT token, _id, count(*) AS tf, any_value(doc_len) AS doc_len
        FROM (SELECT _id, len(listed) AS doc_len, unnest(listed) AS token
              FROM (SELECT _id, {tokens('document')} AS listed FROM coll)) GROUP BY token, _id""",
    "bm25_topk": f"""WITH {COLL}, {bm25(10, 'SELECT item_id AS query_id, text FROM benchmark')}
        SELECT {SCORED_COLUMNS} FROM scored""",
    "bm25_filtered": f"""WITH {COLL},
        {bm25(10, 'SELECT item_id AS query_id, text FROM benchmark', "lang = 'en'")}
        SELECT {SCORED_COLUMNS} FROM scored""",

    "add_rows": f"""WITH {OLD} SELECT {flat()} FROM (
        SELECT _id, document, embedding, lang, n_chars, quality, label FROM old UNION ALL
        SELECT concat('v', vec_id), '', embedding, NULL, NULL, NULL, label FROM embeddings)""",
    "add_embedded": f"""WITH {OLD}, {hashed('vectors', CONVERSATION_ROWS)} SELECT {flat()} FROM (
        SELECT _id, document, CAST(embedding AS DOUBLE[]) AS embedding, lang, n_chars, quality, label
        FROM old UNION ALL
        SELECT id, text, vector, {NO_METADATA} FROM ({CONVERSATION_ROWS}) JOIN vectors USING (id))""",
    "update_fields": merged(
        "SELECT CAST(vec_id * 3 AS VARCHAR) AS _id, embedding, CAST(label AS BIGINT) AS label FROM embeddings",
        ("embedding", "metadata", "label"), insert=False),
    "upsert_full": merged(
        """SELECT CAST(d.doc_id * 2 AS VARCHAR) AS _id, d.text AS document, e.embedding, d.lang,
           d.n_chars, CAST(e.label AS BIGINT) AS label
           FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id""",
        ("document", "embedding", "metadata", "lang", "n_chars", "label"), insert=True),
    "upsert_metadata_only": merged(
        "SELECT CAST(doc_id * 3 AS VARCHAR) AS _id, CAST(quality AS BIGINT) AS quality FROM labels",
        ("metadata", "quality"), insert=True),
    "upsert_document_only": merged(
        "SELECT CAST(doc_id * 2 AS VARCHAR) AS _id, text AS document FROM documents",
        ("document",), insert=True),
    "upsert_duplicates_last_wins": merged(
        """SELECT CAST(conv_id * 7 AS VARCHAR) AS _id, text AS document FROM (
           SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back
           FROM conversations) WHERE back = 1""",
        ("document",), insert=True),
    "delete_ids": simple("_id", """_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels
        WHERE toxic = 1)"""),
    "delete_metadata": simple("_id", "NOT coalesce(quality = 0, FALSE)"),
    "delete_document": simple("_id", f"NOT (lang = 'en' AND {contains('license')})"),
    "validate_dimensions": f"""WITH {COLL} SELECT count(*) AS rows,
        count(*) FILTER (WHERE _id IS NULL) AS null_ids,
        count(*) FILTER (WHERE embedding IS NULL) AS null_vectors,
        count(*) FILTER (WHERE len(embedding) <> {DIMENSION}) AS wrong_vectors FROM coll""",
    "collection_lifecycle": f"""WITH {OLD}, {hashed('vectors', CONVERSATION_ROWS)},
        added AS (
          SELECT _id, document, CAST(embedding AS DOUBLE[]) AS embedding, lang, n_chars, quality, label
          FROM old UNION ALL
          SELECT id, text, vector, {NO_METADATA} FROM ({CONVERSATION_ROWS}) JOIN vectors USING (id)),
        changes AS (SELECT CAST(doc_id * 3 AS VARCHAR) AS _id, CAST(quality AS BIGINT) AS quality
                    FROM labels),
        changed AS (
          SELECT coalesce(o._id, c._id) AS _id,
                 CASE WHEN o._id IS NULL THEN '' ELSE o.document END AS document, o.embedding,
                 CASE WHEN c._id IS NULL THEN o.lang END AS lang,
                 CASE WHEN c._id IS NULL THEN o.n_chars END AS n_chars,
                 CASE WHEN c._id IS NULL THEN o.quality ELSE c.quality END AS quality, o.label
          FROM added o FULL JOIN changes c ON c._id = o._id)
        SELECT {flat()} FROM changed WHERE NOT coalesce(lang = 'de', FALSE)""",

    "vector_distances": """WITH v AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)
        SELECT a.vec_id, round(list_distance(a.x, b.x), 6) + 0.0 AS l2,
               round(list_cosine_distance(a.x, b.x), 6) + 0.0 AS cosine,
               round(list_inner_product(a.x, b.x), 6) + 0.0 AS inner_product
        FROM v a JOIN v b ON b.vec_id = a.vec_id + 1""",
    "knn_l2": knn_query(10, "l2"),
    "knn_cosine": knn_query(10, "cosine"),
    "knn_inner_product": knn_query(10, "inner_product"),
    "knn_most_similar_product": knn_query(10, "negative"),
    "knn_filtered": f"""WITH {COLL}, {VECTORS}, passed AS (
          SELECT * FROM coll WHERE lang = 'en' AND {contains(WORDS)})
        SELECT query_id, rank, h._id, document, lang, round(distance, 6) + 0.0 AS distance
        FROM ({knn(10, 'cosine', source='passed')}) h JOIN coll ON coll._id = h._id""",
    "knn_nested": f"""WITH {COLL}, {VECTORS} SELECT q.query_id, count(h._id) AS n_hits,
        coalesce(string_agg(h._id, ',' ORDER BY h.rank), '') AS ids
        FROM queries q LEFT JOIN ({knn(5, 'l2', 'toxic = 1')}) h ON h.query_id = q.query_id
        GROUP BY q.query_id""",
    "knn_text": f"WITH {HASHED} SELECT {KNN_COLUMNS} FROM ({knn(10, 'cosine', source='hashed_coll')})",
    "knn_large_k": f"""WITH {HASHED}, asked AS (
          SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings WHERE vec_id % 20 = 0)
        SELECT {KNN_COLUMNS} FROM ({knn(600, 'l2', source='hashed_coll').replace('FROM queries', 'FROM asked')})""",
    "approx_full_probe": knn_query(10, "cosine"),
    "approx_probe": f"""WITH {COLL}, {VECTORS},
        means AS (SELECT label, pos, avg(CAST(embedding[pos] AS DOUBLE)) AS x
                  FROM embeddings, unnest(range(1, {DIMENSION + 1})) AS u(pos) GROUP BY ALL),
        lists AS (SELECT label, list(x ORDER BY pos) AS c FROM means GROUP BY label),
        centres AS (SELECT label, list_transform(c, lambda x: x / sqrt(list_inner_product(c, c))) AS c FROM lists),
        near AS (
          SELECT id, label, row_number() OVER (PARTITION BY id ORDER BY
                   list_inner_product(c, c) - 2 * list_inner_product(list_transform(x, lambda y: y / sqrt(list_inner_product(x, x))), c),
                   label) AS place
          FROM (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings) CROSS JOIN centres),
        pairs AS (SELECT DISTINCT q.id AS query_id, r.id AS row_id FROM near q JOIN near r
                  ON q.label = r.label AND q.place <= 4 AND r.place = 1)
        SELECT query_id, rank, _id, round(distance, 6) + 0.0 AS distance FROM (
          SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, _id) AS rank, _id, distance
          FROM (SELECT query_id, _id, list_cosine_distance(CAST(embedding AS DOUBLE[]), vector) AS distance
                FROM pairs JOIN queries USING (query_id) JOIN coll ON _id = CAST(row_id AS VARCHAR)))
        WHERE rank <= 10""",

    "hybrid_simple": f"""WITH {HASHED}, {SIMPLE_TEXT},
        {fused(10, 10, 60, knn(10, 'cosine', "lang = 'en'", 'hashed_coll'))}""",
    "hybrid_simple_texts": f"""WITH {HASHED}
        SELECT {KNN_COLUMNS} FROM ({knn(5, 'cosine', source='hashed_coll')})""",
    "hybrid_text_branch": f"""WITH {COLL}, {bm25(50, one('license ' + WORDS), 'n_chars >= 500')}
        SELECT {SCORED_COLUMNS} FROM scored""",
    "hybrid_text_regex": f"""WITH {COLL},
        {bm25(50, one(WORDS), "lang = 'en' AND regexp_matches(document, '[0-9]')")}
        SELECT {SCORED_COLUMNS} FROM scored""",
    "hybrid_metadata_branch": f"""WITH {COLL} SELECT CAST(0 AS BIGINT) AS query_id, rank, _id,
        CAST(NULL AS DOUBLE) AS score
        FROM (SELECT _id, row_number() OVER (ORDER BY _id) AS rank FROM coll WHERE quality = 0)
        WHERE rank <= 20""",
    "hybrid_knn_only": knn_query(7, "l2", "lang = 'en'"),
    "hybrid_rrf": f"""WITH {COLL}, {VECTORS}, {bm25(30, one(WORDS), "lang = 'en'")},
        {fused(10, 30, 20, knn(20, 'cosine', 'n_chars >= 500'))}""",
    "hybrid_rrf_texts": f"""WITH {COLL}, {VECTORS},
        {bm25(30, 'SELECT item_id AS query_id, text FROM benchmark', "lang = 'en'")},
        {fused(10, 30, 20, knn(20, 'cosine', 'n_chars >= 500'), own_texts=True)}""",
    "hybrid_filtered": f"""WITH {COLL}, {VECTORS}, passed AS (
          SELECT * FROM coll WHERE lang = 'en' AND n_chars >= 500 AND {contains(WORDS)})
        SELECT {KNN_COLUMNS} FROM ({knn(10, 'cosine', source='passed')})""",
    "hybrid_filter_only": f"""WITH {COLL} SELECT CAST(0 AS BIGINT) AS query_id, rank, _id,
        CAST(0 AS DOUBLE) AS distance
        FROM (SELECT _id, row_number() OVER (ORDER BY _id) AS rank FROM coll
              WHERE lang = 'fr' AND {contains(WORDS)}) WHERE rank <= 15""",
    "hybrid_distances": f"""WITH {COLL}, {bm25(25, one('license'), "lang = 'en'")}
        SELECT rank, _id, round(score, 6) AS distances FROM scored""",

    "get_page": simple("_id, document", "lang = 'en' ORDER BY _id LIMIT 20 OFFSET 10"),
    "get_offset_only": simple("_id", "TRUE ORDER BY _id OFFSET 25"),
    "peek": f"WITH {OLD} SELECT {flat()} FROM (SELECT * FROM old ORDER BY _id LIMIT 10)",
    "count": simple("count(*) AS count"),

    "embed_hash": f"""WITH {hashed('vectors', 'SELECT doc_id AS id, text FROM documents')}
        SELECT id AS doc_id, bucket AS pos, round(CAST(value AS DOUBLE), 6) AS value
        FROM vectors_cells WHERE value <> 0""",
    "mean_pool_labels": """WITH rows AS (
          SELECT e.label, CASE WHEN l.toxic = 0 THEN 1 ELSE 0 END AS mask, e.embedding,
                 unnest(range(1, len(e.embedding) + 1)) AS pos
          FROM embeddings e LEFT JOIN labels l ON l.doc_id = e.vec_id)
        SELECT CAST(label AS BIGINT) AS label, pos - 1 AS pos,
          round(CAST(CAST(sum(CAST(embedding[pos] AS DOUBLE) * mask) / greatest(sum(mask), 1) AS FLOAT)
                AS DOUBLE), 6) + 0.0 AS value
        FROM rows GROUP BY label, pos""",
}

# Stored collections: the same rows, and the rows after some writes as the CTE `coll`.

FIRST = COLL.replace("coll AS", "first AS", 1)
AFTER_TEXTS = f"""{FIRST},
  changes AS (SELECT CAST(doc_id * 2 AS VARCHAR) AS _id, text FROM documents),
  upserted AS (SELECT coalesce(o._id, c._id) AS _id, coalesce(c.text, o.document, CASE WHEN o._id IS NULL THEN '' END) AS document, o.lang
               FROM first o FULL JOIN changes c ON c._id = o._id),
  coll AS (SELECT _id, document FROM upserted WHERE NOT coalesce(lang = 'de', FALSE)
           UNION ALL SELECT id, coalesce(text, '') FROM ({CONVERSATION_ROWS}))"""
AFTER_VECTORS = f"""{FIRST},
  changes AS (SELECT CAST(vec_id * 3 AS VARCHAR) AS _id, embedding FROM embeddings),
  updated AS (SELECT o._id, coalesce(c.embedding, o.embedding) AS embedding, CASE WHEN c._id IS NULL THEN o.lang END AS lang
              FROM first o LEFT JOIN changes c ON c._id = o._id),
  coll AS (SELECT * FROM updated WHERE NOT coalesce(lang = 'de', FALSE))"""

SQL |= {
    "update_stored": SQL["update_fields"],
    "delete_stored": simple("_id", """_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels
        WHERE toxic = 1) AND NOT coalesce(quality = 0, FALSE)"""),
    "get_ids_stored": simple("_id, document", "_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE quality = 1)"),
    "filter_stored": SQL["filter_and"],
    "bm25_stored": SQL["bm25_topk"],
    "bm25_after_writes": f"""WITH {AFTER_TEXTS}, {bm25(10, 'SELECT item_id AS query_id, text FROM benchmark')}
        SELECT {SCORED_COLUMNS} FROM scored""",
    "knn_after_writes": f"WITH {AFTER_VECTORS}, {VECTORS} SELECT {KNN_COLUMNS} FROM ({knn(10, 'cosine')})",
    "hybrid_pairs": SQL["hybrid_text_branch"],
    "hybrid_probe": SQL["hybrid_rrf"],
}
