"""The registered queries of this subpackage: thin digests of what the operators give."""

from pyspark.sql import functions as F

from .common import table


def op1_exact_dedup(spark, sf_dir):
    from .exact_dedup import exact_dedup

    found = exact_dedup(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_training_order(spark, sf_dir):
    """Documents as UTF-8 bytes (ids 0-254 and the end token 255, which UTF-8 never has), shuffled into shards."""
    from .training_order import shard_folder, write_training_order

    df = table(spark, sf_dir, "documents", "text").select(F.col("text").cast("binary").alias("tokens"))
    return write_training_order(df, shard_folder(spark), key=20240101, stored=True).drop("path")


def op3_mixing(spark, sf_dir):
    from .mixing import mix

    mixed = mix(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", F.col("taken").cast("bigint").alias("taken"))


def op4_minhash(spark, sf_dir):
    from .minhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), k=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op5_lines(spark, sf_dir):
    from .lines import dedup_lines

    found = dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op6_personal(spark, sf_dir):
    from .personal import PATTERNS, personal_spans

    found = personal_spans(table(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.transform("base", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    terms = F.transform("terms", lambda s: F.concat_ws(":", F.lit("term"), s["start"], s["end"]))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, PATTERNS), F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
                        F.array_join(F.concat(base, terms), ",").alias("spans"))


def op7_suffixes(spark, sf_dir):
    from .suffixes import remove_repeats

    found = remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_toxicity(spark, sf_dir):
    from .toxicity import fold, score, train

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    held_out = F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out")
    return score(docs, model).select("doc_id", held_out, "score", "predicted")


def op9_byte_bpe(spark, sf_dir):
    import public_tokenizers

    from .bpe import encode_documents

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = encode_documents(table(spark, sf_dir, "documents", "doc_id", "text"), path, public_tokenizers.PATTERN, digests=True)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op10_neighbours(spark, sf_dir):
    from .neighbours import nearest

    return nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0)


def op11_divergence(spark, sf_dir):
    from .divergence import source_divergence

    return source_divergence(table(spark, sf_dir, "documents", "text", "lang", "source"))


def op12_decontaminate(spark, sf_dir):
    from .decontaminate import decontaminate

    found = decontaminate(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op13_collocations(spark, sf_dir):
    from .collocations import collocations

    return collocations(table(spark, sf_dir, "documents", "text", "lang"))


def registry():
    return {f.__name__: f for f in (op1_exact_dedup, op2_training_order, op3_mixing, op4_minhash, op5_lines, op6_personal, op7_suffixes, op8_toxicity, op9_byte_bpe,
                                     op10_neighbours, op11_divergence, op12_decontaminate, op13_collocations)}


SMALL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def oracles():
    return {
        "op1_exact_dedup": f"""
            WITH d AS (SELECT doc_id, sha256({SMALL}) AS h FROM documents)
            SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
                   doc_id = max(doc_id) OVER w AS kept, h AS text_sha256
            FROM d WINDOW w AS (PARTITION BY h)""",
        "op4_minhash": f"""
            WITH RECURSIVE worded AS (SELECT doc_id, regexp_extract_all({SMALL}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
            shingled AS (
              SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
                ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS sh
              FROM worded),
            sizes AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n FROM shingled),
            each AS (SELECT doc_id, unnest(sh) AS x FROM shingled),
            shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM each a JOIN each b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
            linked AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
            both_ways AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
            reached(id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT b, root FROM reached JOIN both_ways ON a = id)
            SELECT doc_id, n AS n_shingles, min(root) AS component_id, doc_id = min(root) AS kept
            FROM sizes JOIN reached ON id = doc_id GROUP BY doc_id, n""",
        "op7_suffixes": """
            WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
            strings AS (SELECT doc_id, i, h[i + 1:i + 50] AS s FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM d)),
            firsts AS (SELECT s, min(doc_id) AS least FROM strings GROUP BY s HAVING min(doc_id) < max(doc_id)),
            hits AS (SELECT doc_id, i FROM strings JOIN firsts USING (s) WHERE least < doc_id),
            islands AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM (
              SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new FROM hits)),
            spans AS (SELECT doc_id, k, min(i) AS a, max(i) + 50 AS b FROM islands GROUP BY doc_id, k),
            pieces AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
            cut AS (
              SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, CAST(count(*) AS BIGINT) AS n_spans, max(b) AS last,
                list_reduce(list(CASE WHEN a > before THEN h[before + 1:a] ELSE ''::BLOB END ORDER BY a), lambda x, y: x || y) AS head
              FROM pieces JOIN d USING (doc_id) GROUP BY doc_id)
            SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
              sha256(coalesce(head, ''::BLOB) || CASE WHEN coalesce(last, 0) < n THEN h[coalesce(last, 0) + 1:n] ELSE ''::BLOB END) AS kept_sha256
            FROM d LEFT JOIN cut USING (doc_id)""",
        "op11_divergence": f"""
            WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                regexp_extract_all({SMALL}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents),
            kept AS (SELECT lang, t FROM (SELECT lang, unnest(list_distinct(ts)) AS t FROM d) GROUP BY lang, t HAVING count(*) >= 30),
            n AS (SELECT lang, source, t, count(*) AS n FROM (SELECT lang, source, unnest(ts) AS t FROM d) JOIN kept USING (lang, t) GROUP BY ALL),
            v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
            g AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN n USING (lang, source) GROUP BY ALL),
            p AS (SELECT g.lang, g.source, t, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total + 5 * v) AS p
              FROM g JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN n USING (lang, source, t)),
            q AS (SELECT lang, t, 1 + (1000000000::HUGEINT * (sum(n) + 5)) // (any_value(total) + 5 * any_value(v)) AS q
              FROM n JOIN v USING (lang) JOIN (SELECT lang, sum(n) AS total FROM n GROUP BY lang) USING (lang) GROUP BY lang, t),
            pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                coalesce((SELECT sum(abs(x.p - y.p)) FROM p x JOIN p y USING (lang, t) WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
              FROM g a JOIN g b ON a.lang = b.lang AND a.source != b.source),
            terms AS (SELECT lang, source, 'term' AS part, t AS item, p - q AS value FROM p JOIN q USING (lang, t) WHERE n > 0 AND p > q),
            ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
              FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
            SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50""",
        "op12_decontaminate": f"""
            WITH d AS (SELECT doc_id, regexp_extract_all({SMALL}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
            b AS (SELECT item_id, regexp_extract_all({SMALL}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
            windows AS (SELECT DISTINCT item_id, least(len(ws), 10) AS m, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS w
              FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
            places AS (SELECT doc_id, i, m, array_to_string(ws[i:i + m - 1], ' ') AS w
              FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM windows) WHERE len(ws) >= m)),
            found AS (SELECT doc_id, i, m, item_id FROM places JOIN windows USING (m, w)),
            hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS j FROM found) GROUP BY doc_id),
            items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
              FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
            SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
              sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
            FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
        "op13_collocations": f"""
            WITH pieces AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws
              FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({SMALL}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
            f AS (SELECT lang, k, p, count(*) AS f FROM (
              SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS p FROM (
                SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM pieces, (SELECT unnest([1, 2, 3]) AS k) WHERE len(ws) >= k)) GROUP BY ALL),
            n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
            cut AS (SELECT lang, k, p, f AS a, string_split(p, ' ') AS ws, unnest(range(1, k)) AS c FROM f WHERE k > 1 AND f >= 10),
            scored AS (SELECT cut.lang, cut.k, cut.p, a, c, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
              FROM cut JOIN f x ON x.lang = cut.lang AND x.p = array_to_string(ws[1:c], ' ') JOIN f y ON y.lang = cut.lang AND y.p = array_to_string(ws[c + 1:cut.k], ' ')),
            best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, c) = 1),
            longer AS (SELECT lang, unnest([ws[1] || ' ' || ws[2], ws[2] || ' ' || ws[3]]) AS p, a FROM cut WHERE k = 3 AND c = 1),
            kept AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM longer g WHERE g.lang = b.lang AND g.p = b.p AND 100 * g.a >= 50 * b.a)),
            ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM kept)
            SELECT lang, rank, p AS phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000""",
    }
