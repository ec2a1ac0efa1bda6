"""The registered queries of this subpackage over the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact, language, masked, merkle, minhash, mixing, pages, periods, pieces, quality
from . import secrets, shards, topk

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with the SQL for the same rows if there is one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


@query(
    r"""
    WITH t AS (
      SELECT doc_id,
             sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
      FROM documents)
    SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = min(doc_id) OVER same AS kept, h AS text_sha256
    FROM t WINDOW same AS (PARTITION BY h)
    """
)
def op3_exact_dedup(spark: SparkSession, root: str) -> DataFrame:
    digest = F.sha2(exact.normalised(F.col("text")), 256)
    return exact.exact_groups(table(spark, root, "documents"), carried={"text_sha256": digest})


@query()
def op1_minhash_near_dedup(spark: SparkSession, root: str) -> DataFrame:
    return minhash.near_copies(table(spark, root, "documents"), words=2)


@query()
def op7_secret_scan(spark: SparkSession, root: str) -> DataFrame:
    return secrets.span_digests(secrets.secrets(table(spark, root, "documents")))


#: Relative weights of the tree of domain, language and source.
MIX_WEIGHTS = {
    ("long",): 2.0,
    ("short",): 3.0,
    ("long", "en"): 5.0,
    ("long", "de"): 2.0,
    ("long", "fr"): 2.0,
    ("short", "en"): 4.0,
    ("short", "es"): 3.0,
    ("short", "en", "src0"): 2.0,
}


def domain() -> Column:
    """The tree's first level: whether a source has a long name."""
    return F.when(F.length("source") > 4, "long").otherwise("short")


def _weight(depth: int) -> str:
    cases = " ".join(
        "WHEN "
        + " AND ".join(
            f"{level} = '{value}'"
            for level, value in zip(("domain", "lang", "source"), path, strict=False)
        )
        + f" THEN {weight}"
        for path, weight in MIX_WEIGHTS.items()
        if len(path) == depth
    )
    return f"CASE {cases} ELSE 1.0 END"


def _filled(name: str, above: str, keys: str, parent: str, depth: int) -> str:
    """One level: the smallest fillings first; what is left goes to the rest by weight."""
    family = f"PARTITION BY {parent}" if parent else ""
    joined = f"JOIN {above} USING ({parent})" if parent else f"CROSS JOIN {above}"
    return f"""
    {name}_n AS (SELECT {keys}, sum(room) AS room, {_weight(depth)} AS w FROM leaf GROUP BY {keys}),
    {name}_r AS (
      SELECT {keys}, room, w, (given - coalesce(sum(room) OVER (
                 {family} ORDER BY room / w, {keys}
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER ({family} ORDER BY room / w, {keys}
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
      FROM {name}_n {joined}),
    {name} AS (SELECT {keys}, least(room, w * max(rate) OVER ({family})) AS given FROM {name}_r)"""


@query(
    rf"""
    WITH d AS (
      SELECT doc_id, CASE WHEN length(source) > 4 THEN 'long' ELSE 'short' END AS domain,
             lang, source,
             len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens
      FROM documents),
    leaf AS (SELECT domain, lang, source, sum(tokens) AS t, sum(tokens) * 4.0 AS room
             FROM d GROUP BY domain, lang, source),
    root AS (SELECT 0.8 * sum(t)::DOUBLE AS given FROM leaf),
    {_filled("one", "root", "domain", "", 1)},
    {_filled("two", "one", "domain, lang", "domain", 2)},
    {_filled("three", "two", "domain, lang, source", "domain, lang", 3)},
    plan AS (
      SELECT domain, lang, source, cast(floor(given + 1e-6) AS bigint) // cast(t AS bigint) AS w,
             cast(floor(given + 1e-6) AS bigint) % cast(t AS bigint) AS rest
      FROM three JOIN leaf USING (domain, lang, source) WHERE t > 0),
    run AS (
      SELECT d.*, w, rest, sum(tokens) OVER (
               PARTITION BY domain, lang, source ORDER BY md5(concat_ws('|', '1', w, doc_id))
               ROWS UNBOUNDED PRECEDING) AS upto
      FROM d JOIN plan USING (domain, lang, source))
    SELECT doc_id, domain, lang, source, tokens, cast(w + extra AS integer) AS copies
    FROM (SELECT *, cast(rest > 0 AND upto <= rest AS bigint) AS extra FROM run)
    WHERE w + extra > 0
    """
)
def op9_source_mix(spark: SparkSession, root: str) -> DataFrame:
    """Four fifths of all tokens, four epochs at most, by length of the source's name."""
    return mixing.mix(
        table(spark, root, "documents").withColumn("domain", domain()),
        levels=("domain", "lang", "source"),
        weights=MIX_WEIGHTS,
        share=0.8,
        epochs=4,
    )


@query()
def op10_html_extraction(spark: SparkSession, root: str) -> DataFrame:
    return pages.extracted(table(spark, root, "pages"))


@query(
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: cast(floor(256 * x::DOUBLE) AS bigint)) AS x
      FROM embeddings
      WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT q.vec_id AS query_id, c.vec_id,
             cast(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS bigint)
               AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
    SELECT query_id, cast(row_number() OVER (
             PARTITION BY query_id ORDER BY score DESC, vec_id) AS integer) AS rank, vec_id, score
    FROM s QUALIFY rank <= 5
    """
)
def op6_exact_top_products(spark: SparkSession, root: str) -> DataFrame:
    return topk.top_products(table(spark, root, "embeddings"), F.col("vec_id") % 50 == 0)


@query()
def op2_language_id(spark: SparkSession, root: str) -> DataFrame:
    documents = table(spark, root, "documents")
    model = language.learn(documents.filter(~language.held_out()))
    return language.predicted(documents, model).select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", "score"
    )


@query()
def op5_quality_classifier(spark: SparkSession, root: str) -> DataFrame:
    documents, labels = table(spark, root, "documents"), table(spark, root, "labels")
    model = quality.learn(documents, labels.filter(~language.held_out()))
    return quality.scored(documents, model).select(
        "doc_id", language.held_out().alias("held_out"), "score", "predicted"
    )


@query()
def op8_sentencepiece(spark: SparkSession, root: str) -> DataFrame:
    """Sampled pieces of every text, and whether they give the text back."""
    documents = table(spark, root, "documents").select("doc_id", "text")
    both = pieces.segmented_and_checked(documents, pieces.default_model(spark))
    return both.select("doc_id", "n_pieces", "lossless", "pieces")


@query()
def op4_lm_scoring(spark: SparkSession, root: str) -> DataFrame:
    return masked.pseudo_likelihood(table(spark, root, "documents"))


#: CRC-32 in SQL: the table of all bytes, made by its rule, and the sum over a list of bytes.
_CRC = """crc AS (
      SELECT list_transform(range(256), lambda i: list_reduce(
               list_prepend(i, range(8)),
               lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def _crc(text: str) -> str:
    """SQL for the unsigned CRC-32 of a text's UTF-8 bytes, beside ``crc``."""
    listed = f"regexp_extract_all(hex(encode({text})), '..')"
    numbers = f"list_transform({listed}, lambda b: ('0x' || b)::BIGINT)"
    step = "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {numbers}), {step}), 4294967295)"


SHARDS, SEED = 24, 1


def _half_round(k: int) -> str:
    """One half round of the shuffle in SQL, on ``x, y`` of ``h{k}``."""
    moved, by, size = ("x", "y", "a") if k % 2 == 0 else ("y", "x", "b")
    key, (one, two) = shards.keys(SEED)[k], shards.FACTORS
    mixed = f"{by} * {one} + {key}"
    mixed = f"(xor({mixed}, ({mixed}) >> 29) & {shards.MASK}) * {two} + {key}"
    mixed = f"(xor({mixed}, ({mixed}) >> 29) & {shards.MASK})"
    mixed = f"xor({mixed}, {mixed} >> 15)"
    rest = "y" if moved == "x" else "x"
    return (
        f"h{k + 1} AS (SELECT v, a, b, ({moved} + {mixed}) % {size} AS {moved}, {rest} FROM h{k})"
    )


@query(
    rf"""
    WITH RECURSIVE {_CRC},
    d AS (
      SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size,
             {_crc("coalesce(text, '')")} AS text_crc32
      FROM documents, crc),
    numbered AS (
      SELECT *, row_number() OVER (ORDER BY doc_id NULLS LAST, size, text_crc32) - 1 AS v FROM d),
    sizes AS (SELECT count(*) AS n, cast(ceil(sqrt(count(*))) AS bigint) AS a FROM d),
    dims AS (SELECT n, a, (n + a - 1) // a AS b FROM sizes),
    h0 AS (SELECT v, a, b, v % a AS x, v // a AS y
           FROM (SELECT a, b, unnest(range(a * b)) AS v FROM dims)),
    {", ".join(_half_round(k) for k in range(shards.ROUNDS))},
    moved AS (SELECT v, y * a + x AS place FROM h{shards.ROUNDS}),
    walk AS (
      SELECT v, place FROM moved
      UNION ALL
      SELECT w.v, m.place FROM walk w JOIN moved m ON m.v = w.place, dims WHERE w.place >= n)
    SELECT doc_id, size, text_crc32, 'rows' AS law, cast(place % {SHARDS} AS integer) AS shard,
           place // {SHARDS} AS slot, cast(NULL AS integer) AS grown_shard
    FROM numbered JOIN walk USING (v), dims WHERE place < n
    """
)
def op11_sharding(spark: SparkSession, root: str) -> DataFrame:
    """Law ``rows``: counts of two shards differ by one at most; copies are rows of their own."""
    documents = table(spark, root, "documents")
    placed = shards.sharded(documents, SHARDS, SEED, carry=["doc_id"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


LEAF = ["doc_id", "source", "lang", "n_chars"]
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _sql_leaf(text: str) -> str:
    framed = " || ".join(
        f"coalesce(octet_length(encode({v}::VARCHAR))::VARCHAR || ':' || {v}::VARCHAR, '-')"
        for v in [*LEAF, text]
    )
    return f"sha256({framed})"


def _sql_tree(name: str, leaves: str, levels: int) -> str:
    """Levels of the trees ``t`` over ``leaves (t, i, n, d)``, with the siblings of every node."""
    steps = []
    for k in range(levels):
        nodes = leaves if k == 0 else f"{name}{k}"
        steps.append(
            f"""{name}_s{k} AS (
      SELECT o.t, o.i, coalesce(string_agg(s.d, '' ORDER BY s.i) FILTER (s.i < o.i), '') AS l,
             coalesce(string_agg(s.d, '' ORDER BY s.i) FILTER (s.i > o.i), '') AS r, any_value(o.n) AS n
      FROM {nodes} o JOIN {nodes} s ON o.t = s.t AND o.i // 8 = s.i // 8 GROUP BY o.t, o.i),
    {name}{k + 1} AS (
      SELECT t, i // 8 AS i, (any_value(n) + 7) // 8 AS n,
             CASE WHEN any_value(n) = 1 THEN any_value(d)
                  ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d
      FROM {nodes} GROUP BY t, i // 8)"""
        )
    return ", ".join(steps)


def _sql_folds(name: str, first: str, levels: int, position: str) -> str:
    """Every row's fold and its siblings, level by level."""
    steps = []
    for k in range(levels):
        before = first if k == 0 else f"{name}_f{k}"
        steps.append(
            f"""{name}_f{k + 1} AS (
      SELECT f.* REPLACE (CASE WHEN s.n = 1 THEN f.x ELSE sha256(s.l || f.x || s.r) END AS x,
                          f.side || s.l || s.r AS side)
      FROM {before} f JOIN {name}_s{k} s ON s.t = f.{"one" if name == "top" else "t"}
       AND s.i = f.{position} // {8**k})"""
        )
    return ", ".join(steps)


@query(
    f"""
    WITH {_CRC},
    doc AS (
      SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS t, {_sql_leaf("text")} AS d,
             CASE WHEN {_crc("doc_id::VARCHAR")} % 3 = 0
                  THEN {_sql_leaf(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")} END AS tampered
      FROM documents, crc),
    low0 AS (
      SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST, d) - 1 AS i,
             count(*) OVER (PARTITION BY t) AS n
      FROM doc),
    {_sql_tree("low", "low0", 7)},
    top0 AS (SELECT 0 AS t, t AS i, count(*) OVER () AS n, d FROM low7),
    {_sql_tree("top", "top0", 3)},
    start AS (SELECT doc_id, t, i, 0 AS one, d, coalesce(tampered, d) AS x, '' AS side FROM low0),
    {_sql_folds("low", "start", 7, "i")},
    {_sql_folds("top", "low_f7", 3, "t")}
    SELECT f.doc_id, f.d AS leaf, s.d AS subroot, r.d AS root, sha256(f.side) AS proof_sha256,
           f.x AS folded_root, f.x = r.d AS verified
    FROM top_f3 f JOIN low7 s ON s.t = f.t JOIN top3 r ON r.t = f.one
    """
)
def op12_merkle_manifest(spark: SparkSession, root: str) -> DataFrame:
    """A tree for each language; a third of the leaves, by id, is tampered with and folded."""
    plain = [F.col(name) for name in LEAF]
    lower = F.translate("text", _UPPER, _UPPER.lower())
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    changed = F.when(chosen, merkle.digest(merkle.framed([*plain, lower])))
    found = merkle.manifest(
        table(spark, root, "documents"),
        leaf=merkle.digest(merkle.framed([*plain, F.col("text")])),
        group=F.col("lang"),
        order=[F.col("doc_id")],
        carried={"doc_id": F.col("doc_id"), "tampered": changed},
    )
    refolded = merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    proven = found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.proof(F.col("path")), 256).alias("proof_sha256"),
        refolded.alias("folded_root"),
    )
    return proven.withColumn("verified", F.col("folded_root") == F.col("root"))


@query()
def op13_periodic_runs(spark: SparkSession, root: str) -> DataFrame:
    """Runs of every text, a tenth of the texts made periodic by their id."""
    documents = table(spark, root, "documents").select(
        "doc_id", periods.planted(F.col("text"), F.col("doc_id")).alias("text")
    )
    found = periods.periodic_runs(documents).withColumn("best", periods.strongest(F.col("runs")))
    lines = F.transform(
        "runs",
        lambda run: F.concat(
            F.concat_ws(",", *(run[name].cast("string") for name in ("start", "length", "period"))),
            F.lit("\n"),
        ),
    )
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
