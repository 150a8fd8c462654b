"""The operators' queries over whole tables, with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from barline.llm import (
    conversations, decontamination, exact_dedup, html_text, jaccard_join, license_scan, lm_scoring, merkle, mixing, personal_data, quality,
    secret_scan, warc,
)

Query = Callable[[SparkSession, str], DataFrame]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = secret_scan.BASE + secret_scan.MORE
    found = secret_scan.scan(_table(spark, sf_dir, "documents"), rules)

    def listed(keep) -> F.Column:
        told = F.transform(F.filter("spans", keep), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(told, ",")

    def number(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(r.kind) for r in secret_scan.BASE]
    return found.select(
        "doc_id", *counts, F.sha2(listed(lambda s: s["nth"] < len(secret_scan.BASE)), 256).alias("base_sha256"),
        listed(lambda s: F.lit(True)).alias("spans"),
    )


def _secrets_sql() -> str:
    """Where matches are follows from what lies between them."""
    kinds = []
    for nth, rule in enumerate(secret_scan.BASE + secret_scan.MORE):
        pattern = rule.pattern.replace("'", "''")
        kinds.append(f"""
          SELECT row, list_filter(list_transform(range(1, len(hits) + 1), lambda i: {{'start': at(between, hits, i),
                   'nth': {nth}, 'end': at(between, hits, i) + length(hits[i]), 'kind': '{rule.kind}', 'size': length(kept[i])}}),
                   lambda s: s['size'] >= {rule.least}) AS spans
          FROM (SELECT row, regexp_extract_all(text, '{pattern}') AS hits,
                  regexp_extract_all(text, '{pattern}', {rule.group}) AS kept,
                  regexp_split_to_array(text, '{pattern}') AS between FROM texts)""")
    at = """(list_sum(list_transform(between[1:i], lambda p: length(p)))
             + coalesce(list_sum(list_transform(hits[1:i - 1], lambda p: length(p))), 0))::BIGINT"""
    body = " UNION ALL ".join(kinds).replace("at(between, hits, i)", at)
    told = "string_agg(s.kind || ':' || s.start || ':' || s.end, ',' ORDER BY s.start, s.nth)"
    counts = ", ".join(f"count(*) FILTER (s.nth = {i}) AS n_{r.kind}" for i, r in enumerate(secret_scan.BASE))
    return f"""
        WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
        found AS (SELECT row, unnest(spans) AS s FROM ({body})),
        told AS (SELECT row, {counts}, {told} FILTER (s.nth < {len(secret_scan.BASE)}) AS base, {told} AS spans
                 FROM found GROUP BY row)
        SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secret_scan.BASE)},
          sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM texts LEFT JOIN told USING (row)"""


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


_DEDUP_SQL = f"""
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
      row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
    FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
    WINDOW same AS (PARTITION BY t)"""


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.word_scores(_table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


_LEAKS_SQL = r"""
    WITH told AS (
      SELECT 'd' AS side, doc_id AS id, row_number() OVER () AS row, text FROM documents
      UNION ALL SELECT 'i', item_id, row_number() OVER (), text FROM benchmark),
    split AS (SELECT side, id, row, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM told),
    runs AS (SELECT side, id, row, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM split),
    one AS (SELECT side, id, row, len(s) AS n, unnest(s) AS shingle FROM runs),
    met AS (SELECT d.row, d.id AS doc_id, i.id AS item_id, i.row AS item, any_value(i.n) AS n_item, count(*) AS n_shared
      FROM one d JOIN one i ON d.shingle = i.shingle AND d.side = 'd' AND i.side = 'i' GROUP BY ALL)
    SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment FROM met WHERE n_shared * 100 >= n_item * 80"""


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    templates = license_scan.BASE + license_scan.MORE
    found = license_scan.license_scan(_table(spark, sf_dir, "documents"), templates)
    base = [t.label for t in license_scan.BASE]
    places = F.filter("found", lambda f: f["label"].isin(base))

    def labels(of) -> F.Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda f: f["label"]))), ",")

    starts = F.transform(places, lambda f: f["start"])
    return found.select(
        "doc_id", "n_words", F.size(places).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(places).alias("base_labels"), labels(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda f: f["score"])), F.lit(0.0)).alias("score"),
    )


def _licenses_sql() -> str:
    """Every 64 words in a row that begin with a token of a template, against it; every place of every phrase."""
    phrases, bags = [], []
    for t in license_scan.BASE + license_scan.MORE:
        words = t.text.split()
        if t.exact:
            phrases.append(f"('{t.label}', {words})")
        else:
            tokens = sorted(set(words))
            least = next(n for n in range(len(tokens) + 1) if n >= t.threshold * len(tokens) - 1e-9)
            bags.append(f"('{t.label}', {tokens}, {least})")
    return rf"""
        WITH split AS (SELECT row_number() OVER () AS row, doc_id,
            regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        phrases(label, p) AS (VALUES {", ".join(phrases)}), bags(label, tokens, least) AS (VALUES {", ".join(bags)}),
        places AS (SELECT row, label, unnest(list_filter(range(0, len(w)), lambda i: w[i + 1:i + len(p)] = p)) AS start FROM split, phrases),
        words AS (SELECT row, unnest(w) AS token, generate_subscripts(w, 1) AS i FROM split),
        met AS (SELECT row, i, token, label, len(tokens) AS size, least
            FROM words JOIN (SELECT *, unnest(tokens) AS token FROM bags) USING (token)),
        near AS (SELECT *, i // 64 AS part FROM met UNION ALL SELECT *, i // 64 - 1 FROM met),
        fits AS (SELECT a.row, a.label, count(DISTINCT b.token) / any_value(a.size) AS score FROM met a
            JOIN near b ON a.row = b.row AND a.label = b.label AND a.i // 64 = b.part AND b.i BETWEEN a.i AND a.i + 63
            GROUP BY a.row, a.label, a.i HAVING count(DISTINCT b.token) >= any_value(a.least)),
        every AS (SELECT row, label, start, 1.0::DOUBLE AS score FROM places UNION ALL SELECT row, label, NULL, score FROM fits),
        told AS (SELECT row, count(start) AS n_base, min(start) AS first_word, max(start) AS last_word, max(score) AS score,
            string_agg(DISTINCT label, ',' ORDER BY label) FILTER (start IS NOT NULL) AS base_labels,
            string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM every GROUP BY row)
        SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
            coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
        FROM split LEFT JOIN told USING (row)"""


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(spark, _table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_WARC_SQL = """
    WITH bodies AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
    first AS (SELECT page_id, body, max(page_id) OVER (PARTITION BY body) AS first FROM bodies),
    bits AS (SELECT page_id, first, strlen(body) AS payload_bytes, array_to_string(list_transform(string_split(sha1(body), ''),
        lambda c: substr('0000000100100011010001010110011110001001101010111100110111101111', (strpos('0123456789abcdef', c) * 4 - 3)::INT, 4)), '') AS b FROM first)
    SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(0, 5), lambda k:
          substr(b, (i * 5 + k + 1)::INT, 1)::INT * (16 >> k)))::INT, 1)), '') AS payload_digest,
      CASE WHEN page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN page_id < first THEN first END AS refers_to
    FROM bits"""


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = jaccard_join.jaccard_join(_table(spark, sf_dir, "documents"), words=3, percent=90, slack=2.0)
    return classes.select("doc_id", "n_shingles", "component_id")


_JACCARD_SQL = rf"""
    WITH RECURSIVE split AS (SELECT row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
    runs AS (SELECT row, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s FROM split),
    one AS (SELECT row, len(s) AS n, unnest(s) AS shingle FROM runs),
    met AS (SELECT a.row AS a, b.row AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shared
        FROM one a JOIN one b ON a.shingle = b.shingle AND a.row <> b.row GROUP BY ALL),
    links AS (SELECT a, b FROM met WHERE 100 * shared >= 90 * (na + nb - shared)),
    reach AS (SELECT row AS a, row AS b FROM runs UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
    SELECT x.doc_id, len(x.s) AS n_shingles, y.component_id FROM runs x JOIN (
        SELECT r.a AS row, min(t.doc_id) AS component_id FROM reach r JOIN runs t ON t.row = r.b GROUP BY r.a) y USING (row)"""


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    changed = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = merkle.manifest(_table(spark, sf_dir, "documents"), changed={"text": changed})
    told = rows.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        merkle.folded(F.col("found"), F.col("path")).alias("folded_root"),
    )
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))


#: crc32 of the ASCII text ``{0}``, bit by bit.
_CRC_SQL = """xor(list_reduce(flatten(list_transform(string_split({0}, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, (crc & 1) * 3988292384) END, 4294967295::BIGINT), 4294967295::BIGINT)"""


def _merkle_sql() -> str:
    """Trees level by level; a row's siblings by its place at each level."""
    one = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
    told = " || ".join(one.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}"))
    tampered = f"CASE WHEN {_CRC_SQL.format('doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"
    levels = """
        SELECT tree, 0 AS level, rank AS place, {digest} AS digest, count(*) OVER (PARTITION BY tree) AS n FROM {leaves}
        UNION ALL
        SELECT tree, level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 2) // 3
        FROM {self} WHERE n > 1 GROUP BY tree, level, place // 3"""
    steps = """
        SELECT l.tree, l.rank, u.level,
          coalesce(string_agg(u.digest, '' ORDER BY u.place) FILTER (u.place < l.rank // (3 ** u.level)::BIGINT), '') AS before,
          coalesce(string_agg(u.digest, '' ORDER BY u.place) FILTER (u.place > l.rank // (3 ** u.level)::BIGINT), '') AS after
        FROM {leaves} l JOIN {nodes} u ON u.tree = l.tree AND u.n > 1
          AND u.place // 3 = l.rank // (3 ** (u.level + 1))::BIGINT GROUP BY l.tree, l.rank, u.level"""
    path = "list(before || '|' || after ORDER BY level)"
    return f"""
        WITH RECURSIVE told AS (SELECT doc_id, coalesce('1' || source, '0') AS tree, sha256({told.format(text="text")}) AS leaf,
            sha256({told.format(text=tampered)}) AS found FROM documents),
        leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM told),
        nodes AS ({levels.format(digest="leaf", leaves="leaves", self="nodes")}),
        subroots AS (SELECT 0 AS tree, tree AS name, digest, row_number() OVER (ORDER BY tree) - 1 AS rank FROM nodes WHERE n = 1),
        tops AS ({levels.format(digest="digest", leaves="subroots", self="tops")}),
        low AS (SELECT tree, rank, {path} AS path FROM ({steps.format(leaves="leaves", nodes="nodes")}) GROUP BY tree, rank),
        high AS (SELECT rank, {path} AS path FROM ({steps.format(leaves="subroots", nodes="tops")}) GROUP BY rank),
        proofs AS (SELECT l.*, s.digest AS subroot, (SELECT digest FROM tops WHERE n = 1) AS root,
            list_concat(coalesce(low.path, []), coalesce(high.path, [])) AS path
          FROM leaves l JOIN subroots s ON s.name = l.tree LEFT JOIN low ON low.tree = l.tree AND low.rank = l.rank
          LEFT JOIN high ON high.rank = s.rank),
        folds AS (SELECT *, list_reduce(path, lambda node, p: sha256(split_part(p, '|', 1) || node || split_part(p, '|', 2)), found) AS folded_root FROM proofs)
        SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(path, ''), '|', '')) AS proof_sha256, folded_root,
          folded_root = root AS verified FROM folds"""


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return conversations.repair(conversations.damaged(turns), all_ids=turns.select("conv_id")).report


def _conversations_sql() -> str:
    """Row by row: for each state the cheapest cost with its letters and lines."""
    crc = _CRC_SQL.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
        WITH RECURSIVE hashed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS fate FROM conversations),
        rows AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
            CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
          FROM (SELECT *, unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) FROM hashed WHERE fate <> 0)),
        placed AS (SELECT *, rtrim(text, {blanks}) AS ended, CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE 'o' END AS sort,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS nth FROM rows),
        marked AS (SELECT *, CASE WHEN ended = '' THEN 'b'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY nth) > 1 THEN 'd'
              WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault,
            lag(sort) OVER (PARTITION BY conv_id ORDER BY nth) || sort AS pair FROM placed),
        counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
            count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
            count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM marked GROUP BY conv_id),
        inserts(i, k, letters, lines) AS (VALUES (0, 0, '', []::VARCHAR[]), (1, 1, '', []), (2, 2, '', []), (3, 3, '', []),
            (0, 2, 'I', ['user:']), (0, 3, 'II', ['user:', 'assistant:']), (1, 2, 'I', ['user:']), (1, 3, 'II', ['user:', 'assistant:']),
            (2, 3, 'I', ['assistant:']), (3, 2, 'I', ['user:'])),
        keeps(k, sort, j) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
        roles(k, role, j) AS (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
        edits AS (SELECT k, j, sort, 0 AS cost, 'K' AS letter, NULL::VARCHAR AS role FROM keeps
            UNION ALL SELECT k, j, s, 2, 'R', role FROM roles, (VALUES ('s'), ('u'), ('a'), ('o')) AS sorts(s)
            UNION ALL SELECT k, k, s, 3, 'D', NULL FROM roles, (VALUES ('s'), ('u'), ('a'), ('o')) AS sorts(s)),
        best AS (
          SELECT conv_id, 0::BIGINT AS nth, 0 AS state, {{'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}} AS way FROM (SELECT DISTINCT conv_id FROM conversations)
          UNION ALL
          SELECT b.conv_id, any_value(m.nth), e.j, min({{'cost': b.way.cost + 2 * length(x.letters) + e.cost
                + CASE WHEN m.fault = 't' AND e.letter <> 'D' THEN 1 ELSE 0 END,
              'audit': b.way.audit || x.letters || e.letter,
              'lines': list_concat(b.way.lines, x.lines, CASE WHEN e.letter = 'D' THEN [] ELSE [coalesce(e.role, m.role) || ':' || m.text] END)}})
          FROM best b JOIN marked m ON m.conv_id IS NOT DISTINCT FROM b.conv_id AND m.nth = b.nth + 1
          JOIN inserts x ON x.i = b.state JOIN edits e ON e.k = x.k AND e.sort = m.sort AND (e.letter = 'D' OR m.fault NOT IN ('b', 'd'))
          GROUP BY b.conv_id, e.j),
        ended AS (SELECT b.conv_id, min({{'cost': b.way.cost + 2 * length(x.letters), 'audit': b.way.audit || x.letters, 'lines': list_concat(b.way.lines, x.lines)}}) AS way
          FROM best b LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id JOIN inserts x ON x.i = b.state AND x.k IN (0, 3)
          WHERE b.nth = coalesce(c.n, 0) GROUP BY b.conv_id)
        SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
          coalesce(illegal, 0) AS illegal, e.way.cost AS cost, e.way.audit AS audit, sha256(coalesce(array_to_string(e.way.lines, chr(10)), '')) AS repaired_sha256
        FROM ended e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id"""


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find(_table(spark, sf_dir, "documents"), personal_data.examples(spark))

    def listed(spans: F.Column) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["base"])

    def number(kind: str) -> F.Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in personal_data.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def queries() -> dict[str, Query]:
    found = [
        op1_mixing, op2_secrets, op3_exact_dedup, op4_lm_scores, op5_decontamination, op6_license_scan, op7_warc,
        op8_html_text, op9_quality, op10_jaccard_join, op11_merkle, op12_conversations,
        op13_personal_data,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_secrets": _secrets_sql(), "op3_exact_dedup": _DEDUP_SQL, "op5_decontamination": _LEAKS_SQL,
        "op6_license_scan": _licenses_sql(), "op7_warc": _WARC_SQL, "op10_jaccard_join": _JACCARD_SQL,
        "op11_merkle": _merkle_sql(), "op12_conversations": _conversations_sql(),
    }
