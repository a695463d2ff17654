"""Table maintenance as joins: upserts, updates, relabelling, audits, versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def upsert(old: DataFrame, new: DataFrame, keys: list[str], kept: list[str] = ()) -> DataFrame:
    """old with new's rows: columns of ``kept`` stay as they were first, all others are updated."""
    a, b = old.alias("a"), new.alias("b")
    cond = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    both = a.join(b, cond, "full")
    has_new = F.coalesce(*[F.col(f"b.{k}") for k in keys]).isNotNull()
    out = []
    for c in old.columns:
        if c in keys or c in kept:
            out.append(F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c))
        elif c in new.columns:
            out.append(F.when(has_new, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c))
        else:
            out.append(F.col(f"a.{c}"))
    return both.select(*out)


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old and those rows of new whose keys it lacks (one per key)."""
    return old.unionByName(new.dropDuplicates(keys).join(old.select(*keys), keys, "left_anti"))


def update(rows: DataFrame, changes: DataFrame, key: str, column: str) -> DataFrame:
    """column replaced where changes (key, column) has a row for the key."""
    new = changes.select(key, F.col(column).alias("_new"))
    return rows.join(new, key, "left").withColumn(column, F.coalesce("_new", column)).select(*rows.columns)


def relabel(segments: DataFrame, columns: list[str]) -> DataFrame:
    """columns emptied where no one has reviewed the segment."""
    open_row = F.col("true_topic").isNull() & F.col("true_sub_topic").isNull()
    return segments.select(*[(F.when(~open_row, F.col(c)).alias(c) if c in columns else F.col(c)) for c in segments.columns])


def replace_partition(rows: DataFrame, path: str, partition: str) -> None:
    """Write rows over their partitions of a table, leaving the others."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def orphans(child: DataFrame, parent: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Rows of child whose non-null keys parent lacks."""
    p = parent.select(*[F.col(b).alias(f"_{b}") for _, b in on]).distinct()
    known = child.where(F.expr(" AND ".join(f"`{a}` IS NOT NULL" for a, _ in on)))
    return known.join(p, [F.col(a) == F.col(f"_{b}") for a, b in on], "left_anti")


def filtered(rows: DataFrame, allowed: set[str], **equal) -> DataFrame:
    """Rows with column = value (None: null); columns must be allowed."""
    for c, v in equal.items():
        if c not in allowed:
            raise ValueError(f"{c} is not a column to filter by")
        rows = rows.where(F.col(c).isNull() if v is None else F.col(c) == v)
    return rows


def fingerprint(rows: DataFrame, key: str) -> DataFrame:
    """Count and order-free digest of a set of ids (60 bits of their md5, xored)."""
    each = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 15), 16, 10).cast("long")
    return rows.agg(F.count("*").alias("n"), F.bit_xor(each).alias("digest"))


def lookup(users: DataFrame, chats: DataFrame) -> DataFrame:
    """users (user_id) with their chat_id, null for those without one."""
    return users.join(chats.select("user_id", "chat_id").distinct(), "user_id", "left")


def of_users(segments: DataFrame, reviewed: bool | None = None, most: int | None = None) -> DataFrame:
    """Segments in order of start within their user (``nth`` from 1): all, reviewed or unreviewed ones, the first ``most`` of each."""
    marked = F.col("true_topic").isNotNull() & F.col("true_sub_topic").isNotNull()
    rows = segments if reviewed is None else segments.where(marked if reviewed else F.col("true_topic").isNull() & F.col("true_sub_topic").isNull())
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("user_id").orderBy(F.asc_nulls_first("started_at"), "segment_id")))
    return rows if most is None else rows.where(F.col("nth") <= most)


def ground_truth(segments: DataFrame) -> DataFrame:
    """Segments with a true topic; an error if there are none."""
    rows = segments.where("true_topic IS NOT NULL")
    if rows.isEmpty():
        raise ValueError("no segment has a true topic")
    return rows


def without(rows: DataFrame, users: DataFrame | None = None, ids: DataFrame | None = None) -> DataFrame:
    """rows less those without review (of ``users`` only, if given), or less those of ``ids`` (segment_id)."""
    if ids is not None:
        return rows.join(ids.select("segment_id"), "segment_id", "left_anti")
    unreviewed = rows.where("true_topic IS NULL AND true_sub_topic IS NULL").select("segment_id", "user_id")
    gone = unreviewed if users is None else unreviewed.join(users.select("user_id"), "user_id", "left_semi")
    return rows.join(gone.select("segment_id"), "segment_id", "left_anti")


def with_run(rows: DataFrame, **run) -> DataFrame:
    """rows with the run's metadata, which stands where both have a column."""
    return rows.withColumns({c: F.lit(v) for c, v in run.items()})


def invariants(bridge: DataFrame, source: DataFrame) -> DataFrame:
    """Users whose segments must not be written: an id repeated in a segment, or a processed id in none."""
    repeated = bridge.groupBy("user_id", "segment_id", "msg_id").agg((F.count("*") - 1).alias("n")).groupBy("user_id").agg(F.sum("n").alias("repeated"))
    lost = source.join(bridge.select("user_id", "msg_id"), ["user_id", "msg_id"], "left_anti").groupBy("user_id").agg(F.count("*").alias("lost"))
    both = repeated.join(lost, "user_id", "full").na.fill(0)
    return both.where("repeated > 0 OR lost > 0")


def appended(segments: DataFrame, first_messages: DataFrame, failed: DataFrame) -> DataFrame:
    """Segments of users that did not fail, each under a key made of its user, first message and labels."""
    rows = segments.join(failed.select("user_id"), "user_id", "left_anti").join(first_messages, "segment_id")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("user_id", "first_msg", "topic", "sub_topic")]
    return rows.withColumn("segment_key", F.sha2(F.concat_ws("|", *parts), 256))


def nested_upsert(topics: DataFrame, subs: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Topics and sub-topics after a batch (slug, name, updated_at, subs: array of (slug, name)); of repeated slugs the last stays."""
    last = Window.partitionBy("slug").orderBy(F.desc("updated_at"), "name")
    new = batch.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")
    child = new.select(F.col("slug").alias("topic_slug"), "updated_at", F.explode("subs").alias("s")).select("topic_slug", "s.slug", "s.name", "updated_at")
    return upsert(topics, new.drop("subs"), ["slug"]), upsert(subs, child.dropDuplicates(["topic_slug", "slug"]), ["topic_slug", "slug"])


def touched(topics: DataFrame, changed_subs: DataFrame) -> DataFrame:
    """topics whose sub-topics changed take the latest change as their own."""
    latest = changed_subs.groupBy(F.col("topic_slug").alias("slug")).agg(F.max("updated_at").alias("_u"))
    return topics.join(latest, "slug", "left").withColumn("updated_at", F.greatest("updated_at", F.coalesce("_u", "updated_at"))).drop("_u")


def prompt_version(name) -> F.Column:
    """The version at the end of a prompt's file name (something_prompt_user_v1, or bot); other names less a leading bot_."""
    return F.coalesce(F.nullif(F.regexp_extract(name, r"^[a-z0-9]+_prompt_(?:user|bot)_(v\d+)$", 1), F.lit("")), F.regexp_replace(name, "^bot_", ""))


def get_or_create(known: DataFrame, asked: DataFrame, keys: list[str]) -> DataFrame:
    """known and a row for each asked key that it lacks; ``created`` tells which."""
    new = asked.select(*keys).distinct().join(known.select(*keys), keys, "left_anti").withColumn("created", F.lit(True))
    return known.withColumn("created", F.lit(False)).unionByName(new, allowMissingColumns=True)


def events(rows: DataFrame, kind: str, fields: list[str]) -> DataFrame:
    """Log rows: the kind and the fields as one JSON object."""
    return rows.select("segment_id", F.lit(kind).alias("event"), F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("payload"))


def remap_log(rows: DataFrame, config_id: int, group_id: int | None = None, run_id: int | None = None) -> DataFrame:
    """Log rows of remapped topics (rows: user_id, has_user, from_topic, from_sub_topic, to_topic), with the direction and, in a benchmark, the run they belong to.

    A segment with its user's engagement that had a bot topic goes from bot to user, any other the other way.
    """
    direction = F.when(F.col("has_user"), "bot_to_user").otherwise("user_to_bot")
    fields = F.struct(direction.alias("direction"), F.col("from_topic").alias("original_topic"), F.col("from_sub_topic").alias("original_sub_topic"), F.col("to_topic").alias("remapped_topic"))
    number = lambda n: F.lit(n).cast("long")
    return rows.where(~F.col("from_topic").eqNullSafe(F.col("to_topic"))).select(
        "segment_id", F.lit("taxonomy_remap").alias("event"), "user_id", F.to_json(fields, {"ignoreNullFields": "false"}).alias("payload"),
        number(config_id).alias("config_id"), number(group_id).alias("group_id"), number(run_id).alias("run_id"),
    )


def regenerate(rows: DataFrame, path: str, run: int) -> None:
    """Clear a table and write it anew, as run number ``run``.

    The rows are written beside the old ones, then the run is listed, then older runs are deleted: readers see the old
    table or the new one, and a run that broke off anywhere is simply started again under its number.
    """
    spark = rows.sparkSession
    rows.write.mode("overwrite").parquet(f"{path}/run={run}")
    spark.range(1).select(F.lit(run).cast("long").alias("run")).coalesce(1).write.mode("overwrite").parquet(f"{path}_runs/number={run}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(folder):
        if status.getPath().getName().startswith("run=") and int(status.getPath().getName().removeprefix("run=")) < run:
            fs.delete(status.getPath(), True)


def generated(spark, path: str) -> DataFrame:
    """The rows of the newest run that was listed."""
    newest = spark.read.schema("run long").parquet(f"{path}_runs").agg(F.max("run").alias("run")).first()["run"]
    return spark.read.parquet(f"{path}/run={newest}")


def regenerated(source: DataFrame, written: DataFrame, key: str) -> DataFrame:
    """Counts of a table made anew: rows queried, written and skipped."""
    return source.agg(F.count_distinct(key).alias("queried")).crossJoin(written.agg(F.count_distinct(key).alias("written"))).withColumn("skipped", F.col("queried") - F.col("written"))


def user_sample(users: DataFrame, rate: float, seed: int = 0) -> DataFrame:
    """A share of the users, one at least, the same in every run: those with the smallest digests.

    A histogram of the digests' first 16 bits tells which bins go in whole; only the bin at the edge is ranked.
    """
    rows = users.withColumn("_d", F.md5(F.concat(F.col("user_id").cast("string"), F.lit(f":{seed}")))).withColumn("_bin", F.substring("_d", 1, 4))
    bins = sorted(rows.groupBy("_bin").agg(F.count("*").alias("n")).collect())  # at most 65,536
    n = sum(r["n"] for r in bins)
    left, edge = max(1, int(n * min(1.0, max(0.0, rate)))), "g"
    for r in bins:
        if r["n"] > left:
            edge = r["_bin"]
            break
        left -= r["n"]
    last = rows.where(F.col("_bin") == edge).withColumn("_n", F.row_number().over(Window.partitionBy("_bin").orderBy("_d", "user_id"))).where(F.col("_n") <= left)
    return rows.where(F.col("_bin") < edge).select(*users.columns).unionByName(last.select(*users.columns))


#: Bits of a level of a digest tree, rows that a leaf should have, and most levels below the root (a leaf is a folder).
BITS, LEAF_ROWS, LEVELS = 4, 100_000, 3


def write_digested(rows: DataFrame, path: str, keys: list[str], levels: int) -> None:
    """Write rows in a folder per leaf (by a hash of the key), and beside them the tree: count and digest sum of each node.

    Sums, not xor, so that a row that stands twice counts twice.
    """
    text = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    digest = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
    keyed = rows.withColumn("_leaf", F.xxhash64(*keys).bitwiseAND((1 << BITS * levels) - 1).cast("int")).withColumn("_digest", digest)
    keyed.repartition("_leaf").write.mode("overwrite").partitionBy("_leaf").parquet(path)
    leaves = keyed.groupBy("_leaf").agg(F.count("*").alias("n"), F.sum("_digest").alias("digest"))
    nodes = leaves.select(F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright("_leaf", BITS * (levels - k)).alias("node")) for k in range(levels + 1)])).alias("k"), "n", "digest")
    nodes.groupBy("k.level", "k.node").agg(F.sum("n").alias("n"), F.sum("digest").alias("digest")).coalesce(1).write.mode("overwrite").parquet(f"{path}_digests")


def levels_for(rows: DataFrame) -> int:
    n, levels = rows.count(), 1
    while levels < LEVELS and n > LEAF_ROWS << BITS * levels:
        levels += 1
    return levels


def unequal_leaves(spark, a: str, b: str, levels: int) -> list[int]:
    """The leaves in which two digested tables differ, found from the roots down: below equal nodes nothing is looked at."""
    trees = [spark.read.parquet(f"{x}_digests") for x in (a, b)]
    open_ = [0]
    for level in range(levels + 1):
        left, right = (t.where((F.col("level") == level) & F.col("node").isin(open_)).select("node", F.struct("n", "digest").alias(s)) for t, s in zip(trees, "lr", strict=True))
        unequal = [r["node"] for r in left.join(right, "node", "full").where(~F.col("l").eqNullSafe(F.col("r"))).select("node").collect()]  # at most 2^(BITS * level)
        if not unequal or level == levels:
            return sorted(unequal)
        open_ = [(n << BITS) + i for n in unequal for i in range(1 << BITS)]
    return []


def changes(spark, a: str, b: str, keys: list[str], levels: int) -> DataFrame:
    """keys and how (added, removed, changed) of what differs from table a to table b, written with equally many levels; only unequal leaves are read."""
    leaves = unequal_leaves(spark, a, b, levels)
    side = lambda path, *n: spark.read.parquet(path).where(F.col("_leaf").isin(leaves)).select(*keys, "_digest", *[F.lit(x).alias(c) for x, c in zip(n, ("n_a", "n_b"), strict=True)])
    # grouped, not joined, so that a null key meets itself
    both = side(a, 1, 0).union(side(b, 0, 1)).groupBy(*keys, "_digest").agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))
    each = both.groupBy(*keys).agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"), F.count_if(F.col("n_a") != F.col("n_b")).alias("d")).where("d > 0")
    return each.select(*keys, F.when(F.col("n_a") == 0, "added").when(F.col("n_b") == 0, "removed").otherwise("changed").alias("how"))


def constraints(rows: DataFrame, checks: dict[str, object]) -> DataFrame:
    """Rows that break each named condition (null does not)."""
    one = rows.agg(*[F.count_if(F.coalesce(~ok, F.lit(False))).alias(name) for name, ok in checks.items()])
    return one.unpivot([], list(checks), "check", "broken")


def repeated_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that several rows have."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def template_texts(templates: DataFrame) -> DataFrame:
    """Texts of templates (template_id, content: array of (message, text, content)): the first that is not empty of each
    element, those of a template joined by line breaks; templates without any are left out."""
    one = lambda x: F.coalesce(*[F.nullif(x[c], F.lit("")) for c in ("message", "text", "content")])
    texts = F.array_compact(F.transform("content", one))
    return templates.select("template_id", texts.alias("texts")).where(F.size("texts") > 0).withColumn("full_text", F.array_join("texts", "\n"))
