"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.decontaminate import contaminated
from tallyloom.llm.exact_dedup import exact_duplicates
from tallyloom.llm.jaccard_join import jaccard_components
from tallyloom.llm.line_dedup import without_boilerplate
from tallyloom.llm.merkle_manifest import FIELDS, folded, leaf_of, manifest, siblings_of
from tallyloom.llm.packing import packed, with_lengths
from tallyloom.llm.secret_ledger import secret_spans
from tallyloom.llm.simhash import near_duplicates
from tallyloom.llm.substring_dedup import without_repeats
from tallyloom.llm.token_alignment import alignment
from tallyloom.llm.token_files import token_files
from tallyloom.llm.toxicity import scored
from tallyloom.llm.url_filter import judged, rule_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents")).drop("chain")


def op2_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_spans(documents)

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    listed = F.array_join(
        F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(listed, 256).alias("base_sha256"),
        listed.alias("spans"),
    )


def op3_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(with_lengths(table(spark, sf_dir, "documents")))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"), rule_table(spark))


def op6_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_boilerplate(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id",
        "source",
        "n_lines",
        "n_removed",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return token_files(table(spark, sf_dir, "documents"), path).drop("shard")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_repeats(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op11_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment(table(spark, sf_dir, "documents"), *paths)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Where 7 divides the checksum of the id, a row with one more character is claimed.
    tampered = leaf_of([F.col(name).cast("decimal(38,0)") + 1 if name == "n_chars" else F.col(name) for name in FIELDS])
    claim = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, tampered)
    found = manifest(table(spark, sf_dir, "documents"), claim=claim)
    root = folded(F.coalesce("claim", "leaf"), F.col("proof"))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        siblings_of(F.col("proof")).alias("proof_sha256"),
        root.alias("folded_root"),
        (root == F.col("root")).alias("verified"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_secret_ledger,
        op3_string_tiling,
        op4_best_fit_packing,
        op5_url_rules,
        op6_toxic_segments,
        op7_line_dedup,
        op8_simhash,
        op9_token_files,
        op10_substring_dedup,
        op11_signature_trees,
        op12_token_alignment,
        op13_merkle_manifest,
    )
}

_ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)


def _found(rank: int, kind: str, pattern: str, test: str) -> str:
    return f"""
        SELECT doc_id, {rank} AS rank, '{kind}' AS kind, hit, last, {test} AS counts
        FROM (
            SELECT doc_id, hit,
                CAST(sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id ORDER BY pos) AS BIGINT) AS last
            FROM (
                SELECT doc_id, unnest(hits) AS hit, unnest(gaps[:len(hits)]) AS gap,
                    unnest(range(len(hits))) AS pos
                FROM (
                    SELECT doc_id, regexp_extract_all(t, '{pattern}', 0) AS hits,
                        string_split_regex(t, '{pattern}') AS gaps
                    FROM d
                ) WHERE len(hits) > 0
            )
        )"""


def _leaf(n_chars: str) -> str:
    fields = [f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", n_chars, "text")]
    coded = [f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields]
    return f"sha256({' || '.join(coded)})"


def _crc32(text: str) -> str:
    bits = (
        "list_reduce(list_prepend(xor(crc, byte), range(8)),"
        " lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    )
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda crc, byte: {bits}), 4294967295)"


def _above(nodes: str) -> str:
    return (
        f"list_transform(range((len({nodes}) + 1) // 2),"
        f" lambda i: sha256({nodes}[2 * i + 1] || coalesce({nodes}[2 * i + 2], '')))"
    )


ORACLES = {
    "op1_exact_dedup": """
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
        FROM (
            SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id,
                count(*) OVER (PARTITION BY t) AS group_size
            FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        )""",
    "op2_secret_ledger": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        found AS (
            {_found(0, "assign", _ASSIGN, f"length(regexp_extract(hit, '{_ASSIGN}', 2)) >= 8")}
            UNION ALL {_found(1, "access", "AKIA[A-Z0-9]+", "length(hit) >= 16")}
            UNION ALL {_found(2, "hex", "[0-9a-f]+", "length(hit) >= 32")}
        ),
        listed AS (
            SELECT doc_id,
                count(*) FILTER (kind = 'assign') AS n_assign,
                count(*) FILTER (kind = 'access') AS n_access,
                count(*) FILTER (kind = 'hex') AS n_hex,
                string_agg(concat(kind, ':', last - length(hit), ':', last), ','
                    ORDER BY last - length(hit), rank) AS spans
            FROM found WHERE counts GROUP BY doc_id
        )
        SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
            coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256,
            coalesce(spans, '') AS spans
        FROM d LEFT JOIN listed USING (doc_id)""",
    "op5_url_rules": r"""
        WITH rules(host, path, verdict) AS (
            VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
        ),
        p AS (
            SELECT page_id,
                translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
            FROM pages
        ),
        best AS (
            SELECT page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
                arg_max(verdict, length(r.host || r.path)) AS verdict
            FROM p JOIN rules r ON ends_with('.' || p.host, '.' || r.host)
                AND starts_with(p.path, r.path)
            GROUP BY page_id
        )
        SELECT p.page_id, p.host, p.path, rule, coalesce(verdict, 'allow') AS verdict
        FROM p LEFT JOIN best USING (page_id)""",
    "op7_line_dedup": """
        WITH d AS (
            SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
        ),
        l AS (
            SELECT doc_id, source, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d
        ),
        frequent AS (
            SELECT source, line FROM (
                SELECT source, line, count(DISTINCT doc_id) AS n FROM l
                WHERE trim(line) <> '' GROUP BY source, line
            ) JOIN (SELECT source, count(*) AS pages FROM d GROUP BY source) USING (source)
            WHERE n >= 2 AND n / pages > CAST(0.02 AS DOUBLE)
        )
        SELECT doc_id, l.source, count(*) AS n_lines, count(f.line) AS n_removed,
            sha256(coalesce(string_agg(l.line, chr(10) ORDER BY pos) FILTER (f.line IS NULL), ''))
                AS kept_sha256
        FROM l LEFT JOIN frequent f ON l.source = f.source AND l.line = f.line
        GROUP BY doc_id, l.source""",
    "op10_substring_dedup": r"""
        WITH w AS (
            SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos
            FROM (
                SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
                FROM documents
            )
        ),
        windows AS (
            SELECT doc_id, pos, string_agg(word, ' ') OVER five_and_thirty AS words,
                count(*) OVER five_and_thirty AS n
            FROM w
            WINDOW five_and_thirty AS (
                PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING
            )
        ),
        repeated AS (
            SELECT doc_id, pos FROM (
                SELECT doc_id, pos, count(*) OVER (PARTITION BY words) AS places
                FROM windows WHERE n = 35
            ) WHERE places > 1
        ),
        marked AS (
            SELECT doc_id, pos, word,
                max(CASE WHEN repeats THEN pos END) OVER (PARTITION BY doc_id ORDER BY pos) AS last
            FROM (
                SELECT w.*, r.pos IS NOT NULL AS repeats
                FROM w LEFT JOIN repeated r ON w.doc_id = r.doc_id AND w.pos = r.pos
            )
        )
        SELECT d.doc_id, count(pos) AS n_words, count(pos) FILTER (last > pos - 35) AS n_removed,
            sha256(coalesce(string_agg(word, ' ' ORDER BY pos)
                FILTER (last IS NULL OR last <= pos - 35), '')) AS kept_sha256
        FROM documents d LEFT JOIN marked USING (doc_id) GROUP BY d.doc_id""",
    "op11_signature_trees": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ),
        shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE
                WHEN len(words) >= 5
                    THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
                WHEN len(words) > 0 THEN [array_to_string(words, ' ')] END) AS shingle
            FROM w
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
            FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id
        ),
        links AS (
            SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
            WHERE 100 * common >= 80 * (x.n + y.n - common)
        ),
        reached(a, b) AS (
            SELECT a, b FROM links
            UNION
            SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
        )
        SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, least(d.doc_id, min(r.b)) AS component_id
        FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN reached r ON d.doc_id = r.a
        GROUP BY d.doc_id""",
    "op13_merkle_manifest": f"""
        WITH RECURSIVE leaves AS (
            SELECT doc_id, coalesce('=' || lang, '') AS grp, {_leaf("n_chars")} AS leaf,
                CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0
                    THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END AS claim
            FROM documents
        ),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS slot
            FROM leaves
        ),
        levels(grp, height, nodes) AS (
            SELECT grp, 0, list(leaf ORDER BY slot) FROM placed GROUP BY grp
            UNION ALL
            SELECT grp, height + 1, {_above("nodes")} FROM levels WHERE len(nodes) > 1
        ),
        tops AS (SELECT grp, nodes[1] AS subroot, height FROM levels WHERE len(nodes) = 1),
        crown(height, nodes) AS (
            SELECT 0, list(subroot ORDER BY grp) FROM tops
            UNION ALL
            SELECT height + 1, {_above("nodes")} FROM crown WHERE len(nodes) > 1
        ),
        ways AS (
            SELECT doc_id, leaf, l.height, slot >> l.height AS place, slot, grp,
                l.nodes[xor(slot >> l.height, 1) + 1] AS other
            FROM placed JOIN levels l USING (grp) WHERE len(l.nodes) > 1
            UNION ALL
            SELECT doc_id, leaf, t.height + c.height, n >> c.height, slot, grp,
                c.nodes[xor(n >> c.height, 1) + 1]
            FROM placed
            JOIN (SELECT *, row_number() OVER (ORDER BY grp) - 1 AS n FROM tops) t USING (grp)
            CROSS JOIN crown c WHERE len(c.nodes) > 1
        ),
        folds(grp, slot, height, node) AS (
            SELECT grp, slot, 0, claim FROM placed
            UNION ALL
            SELECT f.grp, f.slot, f.height + 1, sha256(CASE WHEN place & 1 = 1
                THEN other || node ELSE node || coalesce(other, '') END)
            FROM folds f JOIN ways w ON f.grp = w.grp AND f.slot = w.slot AND f.height = w.height
        ),
        proofs AS (
            SELECT grp, slot, sha256(coalesce(string_agg(other, '' ORDER BY height), '')) AS proof_sha256
            FROM ways GROUP BY grp, slot
        ),
        ends AS (SELECT grp, slot, arg_max(node, height) AS folded_root FROM folds GROUP BY grp, slot)
        SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
            folded_root = root AS verified
        FROM placed JOIN tops USING (grp) JOIN ends USING (grp, slot) LEFT JOIN proofs USING (grp, slot)
        CROSS JOIN (SELECT nodes[1] AS root FROM crown WHERE len(nodes) = 1)""",
}
