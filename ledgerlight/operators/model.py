"""Training side of the fraud model: split, encoder, trees, permutation importance."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.operators import boosting
from ledgerlight.operators.boosting import BoostedTrees, Settings, fit_trees
from ledgerlight.operators.clean import UNKNOWN
from ledgerlight.operators.ordered import MAX_ROWS, running_totals
from ledgerlight.operators.ranks import curve_summary, score_curve
from ledgerlight.session import materialise

SEED = 42
TEST_SHARE = 0.2
FRAUD_WEIGHT = 15
UNKNOWN_CODE = -1
MAX_CLASSES = 1000
PREFIX = 4                    # hex digits of the hash that are counted; one prefix has some 1/65,536 of a class
BROADCAST_CODES = 100_000
# Hyper-parameters of the trees.
MAX_ITER, MAX_DEPTH, STEP, L2 = 300, 6, 0.05, 1.0


# --- split -------------------------------------------------------------------

def shuffle_key(key: str | Column, seed: int = SEED) -> Column:
    """Reproducible random order of the rows: a hash text of key and seed."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def test_sizes(class_sizes: dict, share: float = TEST_SHARE) -> dict:
    """Test rows per class: total rounded up, training part shared by largest remainder."""
    total = sum(class_sizes.values())
    train_total = total - math.ceil(share * total)
    exact = {c: n * train_total / total for c, n in class_sizes.items()}
    train = {c: math.floor(v) for c, v in exact.items()}
    spare = train_total - sum(train.values())
    for c in sorted(exact, key=lambda c: (train[c] - exact[c], str(c)))[:spare]:
        train[c] += 1
    return {c: n - train[c] for c, n in class_sizes.items()}


def stratified_split(
    df: DataFrame, key: str, label: str, share: float = TEST_SHARE, seed: int = SEED, part: str = "partie"
) -> DataFrame:
    """Add ``part`` = train / test with exact class shares and no sort of a class.

    Rows are compared with the last test row of their class in hash order.
    That row is found from counts per hash prefix and from the few rows that
    share the prefix in which the cut falls.
    """
    spark = df.sparkSession
    h, prefix = shuffle_key(key, seed), F.substring("_h", 1, PREFIX)
    hashed = df.select(F.col(label).alias("_y"), h.alias("_h"), F.col(key).alias("_id")).withColumn("_b", prefix)
    counts = materialise(hashed.groupBy("_y", "_b").agg(F.count(F.lit(1)).alias("n")))
    sizes = counts.groupBy("_y").agg(F.sum("n").alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(sizes) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    quota = test_sizes({r["_y"]: r["n"] for r in sizes}, share)
    label_type = df.schema[label].dataType.simpleString()
    wanted = spark.createDataFrame([(c, k) for c, k in quota.items() if k > 0], f"_y {label_type}, _k long")

    upto = Window.partitionBy("_y").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (
        counts.withColumn("_upto", F.sum("n").over(upto))   # at most 16^PREFIX prefixes per class
        .join(F.broadcast(wanted.withColumnRenamed("_y", "_c")), F.col("_y").eqNullSafe(F.col("_c")))
        .filter((F.col("_upto") >= F.col("_k")) & (F.col("_upto") - F.col("n") < F.col("_k")))
        .select("_c", F.col("_b").alias("_cb"), (F.col("_k") - F.col("_upto") + F.col("n")).alias("_need"))
    )
    near = hashed.join(F.broadcast(cut), F.col("_y").eqNullSafe(F.col("_c")) & (F.col("_b") == F.col("_cb")))
    rank = F.row_number().over(Window.partitionBy("_y").orderBy("_h", "_id"))
    last = (
        near.withColumn("_rank", rank)
        .filter(F.col("_rank") == F.col("_need"))
        .select(F.col("_y").alias("_c"), F.struct(F.col("_h").alias("h"), F.col("_id").alias("id")).alias("_last"))
    )
    own = F.struct(h.alias("h"), F.col(key).alias("id"))
    return (
        df.join(F.broadcast(materialise(last)), F.col(label).eqNullSafe(F.col("_c")), "left")   # one row per class
        .withColumn(part, F.when(own <= F.col("_last"), "test").otherwise("train"))
        .drop("_c", "_last")
    )


# --- ordinal encoder ---------------------------------------------------------

def fit_encoder(train: DataFrame, columns: Sequence[str], max_rows: int = MAX_ROWS) -> DataFrame:
    """(variable, modalite, code): categories of the training rows in text order, from 0."""
    pairs = [
        F.struct(F.lit(c).alias("variable"), F.coalesce(F.col(c), F.lit(UNKNOWN)).alias("modalite")) for c in columns
    ]
    seen = materialise(train.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").distinct())
    codes = running_totals(seen, ["variable"], ["modalite"], {"code": F.lit(1)}, max_rows)
    return materialise(codes.withColumn("code", (F.col("code") - 1).cast("double")))


def apply_encoder(df: DataFrame, encoder: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace categories by their codes; a category never seen becomes -1."""
    small = encoder.limit(BROADCAST_CODES + 1).count() <= BROADCAST_CODES
    for c in columns:
        codes = encoder.filter(F.col("variable") == c).select(F.col("modalite").alias("_m"), F.col("code").alias("_code"))
        df = (
            df.join(F.broadcast(codes) if small else codes, F.coalesce(F.col(c), F.lit(UNKNOWN)) == F.col("_m"), "left")
            .withColumn(c, F.coalesce("_code", F.lit(float(UNKNOWN_CODE))))
            .drop("_m", "_code")
        )
    return df


def encoder_values(encoder: DataFrame) -> DataFrame:
    return encoder.select("variable", "code", "modalite").orderBy("variable", "code")


# --- trees -------------------------------------------------------------------

def fit_model(
    train: DataFrame, features: Sequence[str], label: str, max_iter: int = MAX_ITER, max_depth: int = MAX_DEPTH,
    step: float = STEP, fraud_weight: float = FRAUD_WEIGHT, seed: int = SEED, l2: float = L2, **more,
) -> BoostedTrees:
    """Boosted trees on the encoded features, frauds weighted up; nulls and NaN have a branch of their own.

    ``more``: further fields of ``boosting.Settings``.
    """
    settings = Settings(max_iter=max_iter, max_depth=max_depth, step=step, l2=l2, **more)
    weight = F.when(F.col(label) == 1, float(fraud_weight)).otherwise(1.0)
    return fit_trees(train, features, label, weight, settings, seed)


def model_features(model: BoostedTrees) -> list[str]:
    return model.features


def add_probability(df: DataFrame, model: BoostedTrees, score: str = "fraud_proba") -> DataFrame:
    """Probability of the fraud class; the feature columns of ``df`` stay as they are."""
    return boosting.add_probability(df, model, score)


# --- permutation importance --------------------------------------------------

ROUNDS = 6
DONOR_BYTES = 64 << 20        # bin numbers of whole features that a task reads at once
PACKED = 4_000                # rows packed into arrays that are scored together


def permutation_sides(n: int) -> tuple[int, int]:
    """Sides a, b of the rectangle with the fewest cells beside the n rows, a among the 64 numbers from the root of n on."""
    root = math.isqrt(max(n, 1) - 1) + 1
    return min(((a, -(-n // a)) for a in range(root, root + 64)), key=lambda s: (s[0] * s[1] - n, s[0]))


def keyed_move(v: Column, key: Column, k: Column) -> Column:
    text = F.concat_ws(":", v.cast("string"), key, k.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def permuted(i: Column, n: int, key: Column) -> Column:
    """A random permutation of 0 .. n-1, as an expression: where row ``i`` goes.

    A Feistel network over a rectangle of cells: in turn each coordinate moves by a keyed hash of the other,
    so every round can be undone.  A cell outside of the rows is sent on until it falls on a row; the cells outside are
    few and a path never meets one twice, so as many steps are enough.
    """
    a, b = permutation_sides(n)

    def one_round(s: Column, k: Column) -> Column:
        left = F.when(k % 2 == 0, (s["l"] + keyed_move(s["r"], key, k)) % a).otherwise(s["l"])
        right = F.when(k % 2 == 1, (s["r"] + keyed_move(s["l"], key, k)) % b).otherwise(s["r"])
        return F.struct(left.alias("l"), right.alias("r"))

    def network(x: Column) -> Column:
        start = F.struct(F.floor(x / F.lit(b)).cast("long").alias("l"), (x % b).cast("long").alias("r"))
        return F.aggregate(F.array(*[F.lit(k) for k in range(ROUNDS)]), start, one_round, lambda s: s["l"] * b + s["r"])

    x = network(i.cast("long"))
    spare = a * b - n
    return F.aggregate(F.sequence(F.lit(1), F.lit(spare)), x, lambda at, _: F.when(at < n, at).otherwise(network(at))) if spare else x


def add_permuted(df: DataFrame, to: str, i: str, n: int, key: str) -> DataFrame:
    """Column ``to`` = ``permuted`` of the columns ``i`` and ``key``.

    Each round is a column of its own, so that Spark compiles it and takes each hash once; only the few cells
    outside of the rows go through the expression.
    """
    a, b = permutation_sides(n)
    x, left, right = F.col(i).cast("long"), F.col("_left"), F.col("_right")
    out = df.withColumns({"_left": F.floor(x / F.lit(b)).cast("long"), "_right": x % b})
    for k in range(ROUNDS):
        if k % 2 == 0:
            out = out.withColumn("_left", (left + keyed_move(right, F.col(key), F.lit(k))) % a)
        else:
            out = out.withColumn("_right", (right + keyed_move(left, F.col(key), F.lit(k))) % b)
    out = out.withColumn(to, left * b + right).drop("_left", "_right")
    return out.withColumn(to, F.when(F.col(to) < n, F.col(to)).otherwise(permuted(F.col(to), n, F.col(key)))) if a * b > n else out


def move_tables(n: int, keys: Sequence[str]) -> np.ndarray:
    """(keys, ROUNDS, side): every move of ``permuted`` for each key.  A move depends on one coordinate, so there are some
    square root of n of them in a round, and a number goes through the rounds by looking them up."""
    a, b = permutation_sides(n)
    out = np.zeros((len(keys), ROUNDS, max(a, b)), np.int32)
    for own, key in zip(out, keys, strict=True):
        for k, moves in enumerate(own):
            side, of = (a, b) if k % 2 == 0 else (b, a)
            moves[:of] = [int(hashlib.md5(f"{v}:{key}:{k}".encode()).hexdigest()[:8], 16) % side for v in range(of)]
    return out


def permuted_by(moves: np.ndarray, i: np.ndarray, n: int) -> np.ndarray:
    """``permuted`` of the numbers ``i`` by the moves of one key."""
    a, b = permutation_sides(n)

    def network(x: np.ndarray) -> np.ndarray:
        left, right = np.divmod(x, b)
        for k in range(ROUNDS):
            if k % 2 == 0:
                left = (left + moves[k].take(right)) % a
            else:
                right = (right + moves[k].take(left)) % b
        return left * b + right

    out = network(i.astype(np.int64))
    while len(outside := np.flatnonzero(out >= n)):
        out[outside] = network(out[outside])
    return out


def numbered_rows(
    df: DataFrame, features: Sequence[str], key: str, label: str, sample: int | None, seed: int, max_rows: int
) -> tuple[DataFrame, int]:
    """(features..., _y, _id, _i), written once: rows numbered from 0 in hash order; and how many there are."""
    rows = df.select(*features, F.col(label).alias("_y"), F.col(key).alias("_id")).withColumn("_h", shuffle_key("_id", seed))
    if sample is not None:
        rows = rows.orderBy("_h", "_id").limit(sample)
    numbered = materialise(
        running_totals(rows.withColumn("_all", F.lit(0)), ["_all"], ["_h", "_id"], {"_i": F.lit(1)}, max_rows)
        .withColumn("_i", F.col("_i") - 1).drop("_all", "_h")
    )
    n = numbered.count()
    if n == 0:
        raise ValueError("no rows to evaluate")
    return numbered, n


def permuted_rows(
    df: DataFrame, features: Sequence[str], key: str, label: str, repeats: int = 5, sample: int | None = None,
    seed: int = SEED, max_rows: int = MAX_ROWS,
) -> DataFrame:
    """(feature, essai, key, label, features...): every row once as it is (feature "") and once for each feature and
    repeat, that feature taken from another row by a random permutation of its own.

    Rows get a number in hash order and fetch the one value by an equi-join on the number.
    ``sample`` takes a random sample of that many rows instead of all.
    """
    return permuted_copies(*numbered_rows(df, features, key, label, sample, seed, max_rows), features, key, label, repeats, seed)


def permuted_copies(numbered: DataFrame, n: int, features: Sequence[str], key: str, label: str, repeats: int, seed: int) -> DataFrame:
    """``permuted_rows`` of ``numbered_rows``."""
    shuffles = [F.struct(F.lit("").alias("feature"), F.lit(0).alias("essai"))]
    shuffles += [F.struct(F.lit(f).alias("feature"), F.lit(r).alias("essai")) for f in features for r in range(repeats)]
    # Every row becomes 1 + features * repeats rows, so the rows are spread over the tasks first.
    tasks = int(numbered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = numbered.repartition(tasks, "_i").withColumn("_s", F.explode(F.array(*shuffles))).select("*", "_s.*").drop("_s")
    named = F.concat_ws(":", F.lit(str(seed)), "feature", F.col("essai").cast("string"))
    each = add_permuted(each.withColumn("_named", named), "_from", "_i", n, "_named").drop("_named")
    donors = numbered.select(F.col("_i").alias("_from"), *[F.col(f).alias(f"_d_{f}") for f in features])
    return (
        each.withColumn("_from", F.when(F.col("feature") == "", F.col("_i")).otherwise(F.col("_from")))
        .join(donors, "_from")
        .withColumns({f: F.when(F.col("feature") == f, F.col(f"_d_{f}")).otherwise(F.col(f)) for f in features})
        .select("feature", "essai", F.col("_id").alias(key), F.col("_y").alias(label), *features)
    )


def packed_rows(numbered: DataFrame, trees: BoostedTrees, coded: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(i, y, f0, f1, ...), written once: numbers, labels (-1: null) and bin numbers of some thousand rows as arrays of bytes."""
    names = ["i", "y", *[f"f{k}" for k in range(len(trees.features))]]
    truth = F.when(F.col("_y").isNull(), -1).otherwise((F.col("_y") != 0).cast("int"))

    def pack(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for k in range(0, b.num_rows, PACKED):
                i, y, *columns = [c.to_numpy(zero_copy_only=False) for c in b.slice(k, PACKED).columns]
                arrays = [i.astype(np.int32), y.astype(np.int8), *trees.bins.numbers([c.astype(np.float64) for c in columns])]
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in arrays], names=names)

    table = coded(numbered).select("_i", truth.alias("_y"), *[boosting.as_double(f).alias(f"_f{k}") for k, f in enumerate(trees.features)])
    return materialise(table.mapInArrow(pack, ", ".join(f"{c} binary" for c in names)))


def shuffle_curves(
    numbered: DataFrame, n: int, trees: BoostedTrees, coded: Callable[[DataFrame], DataFrame], features: Sequence[str], repeats: int,
    seed: int, score: str, max_rows: int,
) -> DataFrame:
    """(feature, essai, pr_auc) of the rows of ``permuted_rows``, each with the probability that its trees give it.

    A row is scored together with its copies (``moved_scorer``).  Trees see bin numbers only, so a copy takes the bin number
    of the other row, from arrays that the tasks get: at most DONOR_BYTES, so some features at a time.
    """
    spark, kind = numbered.sparkSession, trees.bins.kind
    packed = packed_rows(numbered, trees, coded)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = -(-len(features) // max(1, DONOR_BYTES // (n * np.dtype(kind).itemsize)))
    out = []
    for step in range(steps):
        some = list(features[step * len(features) // steps : (step + 1) * len(features) // steps])
        places = [trees.features.index(f) for f in some]
        shuffles = [("", 0)] * (step == 0) + [(f, r) for f in some for r in range(repeats)]
        donors = np.empty((len(some), n), kind)
        for at, *found in packed.select("i", *[f"f{k}" for k in places]).toLocalIterator(prefetchPartitions=True):
            for own, x in zip(donors, found, strict=True):
                own[np.frombuffer(at, np.int32)] = np.frombuffer(x, kind)
        moves = move_tables(n, [f"{seed}:{f}:{r}" for f in some for r in range(repeats)])
        given = spark.sparkContext.broadcast((donors, moves))

        def run(batches: Iterator[pa.RecordBatch], given=given, places=places, first=step == 0):
            score_all, (donors, moves) = trees.moved_scorer(), given.value
            for b in batches:
                for at in range(b.num_rows):
                    i, y, *numbers = [np.frombuffer(c[at].as_py(), t) for c, t in zip(b.columns, (np.int32, np.int8, *[kind] * len(trees.features)), strict=True)]
                    moved = {
                        f: np.stack([donors[k].take(permuted_by(moves[k * repeats + r], i, n)) for r in range(repeats)]) for k, f in enumerate(places)
                    }
                    plain, found = score_all(np.stack(numbers), moved)
                    known = np.flatnonzero(y >= 0)
                    label = pa.array(y[known].astype(np.int32))
                    for number, x in enumerate([plain] * first + [x for f in places for x in found[f]]):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(known), number, np.int32)), label, pa.array(x[known])], names=["_g", "_y", score]
                        )

        copies = packed.repartition(tasks).mapInArrow(run, f"_g int, _y int, `{score}` double")
        curve = score_curve(copies, "_y", score, ["_g"], max_rows)
        ap = materialise(curve_summary(curve, ["_g"]).select("_g", "pr_auc"))
        given.destroy()
        names = spark.createDataFrame([(k, *s) for k, s in enumerate(shuffles)], "_g int, feature string, essai int")
        out.append(ap.join(F.broadcast(names), "_g").select("feature", "essai", "pr_auc"))
    return reduce(DataFrame.unionAll, out)


def permutation_importance(
    df: DataFrame, scorer: Callable[[DataFrame], DataFrame], features: Sequence[str], key: str, label: str,
    score: str = "fraud_proba", repeats: int = 5, sample: int | None = None, seed: int = SEED,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Loss of average precision when one feature is shuffled: (feature, importance_mean, importance_std).

    All shuffles are scored and ranked beside the unshuffled rows (see ``permuted_rows``).  A scorer of trees scores the
    copies of a row together (``shuffle_curves``), any other one gets the rows of ``permuted_rows``.
    """
    numbered, n = numbered_rows(df, features, key, label, sample, seed, max_rows)
    trees = getattr(scorer, "trees", None)
    if trees is not None and sorted(trees.features) == sorted(features) and n * np.dtype(trees.bins.kind).itemsize <= DONOR_BYTES:
        ap = shuffle_curves(numbered, n, trees, scorer.coded, features, repeats, seed, score, max_rows)
    else:
        curve = score_curve(scorer(permuted_copies(numbered, n, features, key, label, repeats, seed)), label, score, ["feature", "essai"], max_rows)
        ap = materialise(curve_summary(curve, ["feature", "essai"]).select("feature", "essai", "pr_auc"))
    loss = ap.filter(F.col("feature") == "").select("pr_auc").scalar() - F.col("pr_auc")
    return (
        ap.filter(F.col("feature") != "").withColumn("_loss", loss)
        .groupBy("feature")
        .agg(F.avg("_loss").alias("importance_mean"), F.stddev_pop("_loss").alias("importance_std"))
        .orderBy(F.desc("importance_mean"), "feature")
    )


def top_importance(importance: DataFrame, n: int = 10) -> DataFrame:
    return importance.orderBy(F.desc("importance_mean"), "feature").limit(n)
