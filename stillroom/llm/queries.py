"""The registered queries of the text operators; each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stillroom.llm.common import ship, stored
from stillroom.plans import table
from stillroom.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        @wraps(function)
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = shipped
        if sql is not None:
            SQL[function.__name__] = sql.strip()
        return function

    return register


@query()
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stillroom.llm.language import identify

    return identify(table(spark, sf_dir, "documents"))


@query()
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stillroom.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query(
    r"""
    WITH doc AS (SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
    item AS (SELECT item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
    window_of AS (
      SELECT DISTINCT item_id, m, array_to_string(list_slice(w, pos, pos + m - 1), ' ') AS passage
      FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS pos FROM (SELECT *, least(len(w), 10) AS m FROM item WHERE len(w) > 0))),
    start_of AS (
      SELECT doc_id, pos, m, array_to_string(list_slice(w, pos, pos + m - 1), ' ') AS passage
      FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS pos FROM doc, (SELECT DISTINCT m FROM window_of) WHERE len(w) >= m)),
    hit AS (SELECT doc_id, pos, m, item_id FROM start_of JOIN window_of USING (passage, m)),
    covered AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT DISTINCT doc_id, unnest(range(pos, pos + m)) AS k FROM (SELECT DISTINCT doc_id, pos, m FROM hit)) GROUP BY 1),
    named AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM hit GROUP BY 1)
    SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
      sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
    FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
    """
)
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stillroom.llm.decontaminate import find_passages

    found = find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query()
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stillroom.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), end_id=1)


@query()
def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stillroom.llm.idstore import read_store, write_store

    folder = scratch_path(spark, "id-store")
    write_store(table(spark, sf_dir, "documents"), folder, end_id=2)
    return read_store(spark, folder)


#: The rules of op9_url_rules, in their order, and the patterns that judge other URLs.
URL_PREFIXES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
URL_PATTERNS = [
    r"://([^/?#]*\.)?(casino|pills)[^/?#]*", r"\b(casino|pills|bets)\b", r"\bspam-farm\b", r"\bcheap-pills\b", r"/wp-login\b",
    r"\bcalendar/[0-9]{4}/[0-9]{2}/[0-9]{2}\b", r"\bads\b[^/]*\btrack\b",
]


@query(
    r"""
    WITH address AS (
      SELECT page_id, url,
        coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
        translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS small
      FROM pages),
    judged AS (
      SELECT *, CASE
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/' END AS rule,
        coalesce(regexp_matches(small, '://([^/?#]*\.)?(casino|pills)[^/?#]*|\b(casino|pills|bets)\b|\bspam-farm\b|\bcheap-pills\b|/wp-login\b|\bcalendar/[0-9]{4}/[0-9]{2}/[0-9]{2}\b|\bads\b[^/]*\btrack\b'), false) AS found
      FROM address)
    SELECT page_id, host, path, rule,
      CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL OR found THEN 'block' ELSE 'allow' END AS verdict
    FROM judged
    """
)
def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stillroom.llm.urls import Pattern, Prefix, judge, unfiled

    prefixes, patterns = [Prefix(*p) for p in URL_PREFIXES], [Pattern(p) for p in URL_PATTERNS]
    if unfiled([*prefixes, *patterns]):
        raise AssertionError(f"rules that every URL would run: {unfiled([*prefixes, *patterns])}")
    judged = judge(table(spark, sf_dir, "pages"), prefixes, patterns)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query(
    r"""
    WITH page AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
    digest AS (SELECT page_id, list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((16 * (strpos('0123456789abcdef', substr(hex, (5 * i) // 4 + 1, 1)) - 1) + strpos('0123456789abcdef', substr(hex, (5 * i) // 4 + 2, 1)) - 1) // (CASE (5 * i) % 4 WHEN 0 THEN 8 WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 1 END)) % 32 + 1, 1)), 'string_agg', '') AS payload_digest FROM page),
    top AS (SELECT payload, max(page_id) AS top FROM page GROUP BY 1)
    SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN page_id <> top THEN top END AS refers_to
    FROM page JOIN digest USING (page_id) JOIN top USING (payload)
    """
)
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stillroom.llm.warc import assemble, captures, read_records, write_archives

    folder = scratch_path(spark, "archives")
    files = write_archives(table(spark, sf_dir, "pages"), folder, revisit_from=0)
    records = stored(read_records(spark, folder, files), "records")
    return captures(stored(assemble(records), "captures"))


@query()
def op2_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stillroom.llm.chat import digests, format_windows

    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digests(format_windows(given.unionByName(own), budget=256, history_tokens=64))


@query(
    r"""
    WITH doc AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
        list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
        string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    gram AS (SELECT doc_id, pos, list_slice(w, pos, pos + 4) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS pos FROM doc WHERE len(w) >= 5)),
    often AS (SELECT doc_id, g FROM gram GROUP BY 1, 2 HAVING count(*) > 1),
    repeated AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(pos, pos + 5)) AS k FROM gram JOIN often USING (doc_id, g)) GROUP BY 1),
    line AS (SELECT doc_id, host, at_line, CASE WHEN regexp_matches(x, '\p{L}') THEN trim(regexp_replace(regexp_replace(lower(x), '\p{Nd}+', '0', 'g'), '[\s[:punct:]]+', ' ', 'g')) END AS norm, len(list_filter(string_split_regex(x, '[\x20\x09-\x0D]+'), lambda y: y <> '')) AS n
      FROM (SELECT doc_id, host, generate_subscripts(lines, 1) AS at_line, unnest(lines) AS x FROM doc)),
    held AS (SELECT host, norm, count(DISTINCT doc_id) AS docs FROM line WHERE norm IS NOT NULL GROUP BY 1, 2),
    hosts AS (SELECT host, count(*) AS all_docs FROM doc GROUP BY 1),
    gone AS (SELECT doc_id, count(*) AS n_lines, sum(n) AS n_gone FROM line JOIN held USING (host, norm) JOIN hosts USING (host)
      WHERE docs > 2 AND docs > 0.02 * all_docs GROUP BY 1),
    figure AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))))::BIGINT AS n_dup_lines,
        coalesce(n, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0)::BIGINT AS n_removed_lines, (len(w) - coalesce(n_gone, 0))::BIGINT AS left_words
      FROM doc LEFT JOIN repeated USING (doc_id) LEFT JOIN gone USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
      NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND left_words >= 0.5 * n_words AS kept, n_removed_lines, left_words, left_words < 0.5 * n_words AS depleted
    FROM figure
    """
)
def op1_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stillroom.llm.lines import judge

    judged = judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.size("removed_lines").cast("long").alias("n_removed_lines"), "left_words", "depleted")


@query()
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stillroom.llm.secrets import find_secrets

    return find_secrets(table(spark, sf_dir, "documents")).select("doc_id", "start", "length", "value_sha256", "score", "is_secret")


@query(
    r"""
    WITH RECURSIVE doc AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
    gram AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(list_slice(w, pos, pos + 3), ' ') END AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS pos FROM doc WHERE len(w) > 0)),
    size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY 1),
    met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM gram a JOIN gram b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
    link AS (SELECT a, b FROM met JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * met.n >= 80 * (x.n + y.n - met.n)),
    reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
    named AS (SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(first, doc_id)) AS component_id
      FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS first FROM reach GROUP BY 1) USING (doc_id))
    SELECT *, doc_id = component_id AS kept FROM named
    """
)
def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stillroom.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query(
    r"""
    WITH word AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents) WHERE t <> '' GROUP BY 1, 2),
    asked AS (SELECT item_id, t, count(*) AS c FROM (SELECT item_id, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) WHERE t <> '' GROUP BY 1, 2),
    doc AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM word GROUP BY 1),
    whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM doc),
    weight AS (SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w FROM (SELECT t, count(*) AS df FROM word GROUP BY 1), whole),
    scored AS (SELECT item_id, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // terms))))::BIGINT AS score
      FROM asked JOIN weight USING (t) JOIN word USING (t) JOIN doc USING (doc_id), whole GROUP BY 1, 2)
    SELECT item_id, rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM scored WHERE score > 0) WHERE rank <= 20
    """
)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stillroom.llm.lexical import search

    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    r"""
    WITH RECURSIVE byte AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) r(i))),
    run AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents) WHERE length(run) >= 6 GROUP BY 1, 2),
    coded AS (SELECT run, n, flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [192 + (unicode(ch) >> 6), 128 + (unicode(ch) & 63)] END)) AS bytes FROM run),
    hashed AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, bytes), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h FROM coded, byte),
    word AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed) WHERE length(word) >= 6 GROUP BY 1 HAVING sum(n) >= 5),
    less AS (SELECT word, n, i, left(word, i::INT) || substr(word, i::INT + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM word)),
    near AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
      UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN word b ON a.rest = b.word
      UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN word b ON a.rest = b.word),
    top AS (SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, encode(near)) AS place FROM near),
    judged AS (SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form, CASE WHEN near_n >= 5 * n THEN near_n END AS form_n FROM word LEFT JOIN (FROM top WHERE place = 1) USING (word)),
    chain AS (SELECT word, word AS root FROM judged UNION ALL SELECT chain.word, form FROM chain JOIN judged ON judged.word = root WHERE form IS NOT NULL)
    SELECT word, form, root, judged.n, n_near, form_n FROM judged JOIN (SELECT chain.word, root FROM chain JOIN judged ON judged.word = root WHERE form IS NULL) USING (word)
    """
)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stillroom.llm.spelling import variants

    return variants(table(spark, sf_dir, "documents"))
