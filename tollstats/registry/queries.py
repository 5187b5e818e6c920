"""The named queries: each takes a session and a folder of given tables.

All of them read the whole tables. Years and thresholds are parameters that
suit the given data, and a row limit occurs only in the top-k reports.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollstats.functions.casts import CASTS, to_bigint
from tollstats.operators import sampling
from tollstats.operators.dedup import dedup_key
from tollstats.operators.evaluation import METRICS, confusion_matrix, metrics_table, recall_by_class
from tollstats.operators.quantiles import exact_quantiles
from tollstats.operators.sampling import oversample, split_side
from tollstats.operators.surrogate import assign_ids
from tollstats.plans import activity, features, ingest, modelrules, models, reports, sqlreports
from tollstats.schema import FLUJO_SCHEMA, ID_COLUMN, MALFORMED, MEASURE_COLUMNS, RAW_NAMES, STATION_KEY, Tables
from tollstats.sources.csv_files import scan_csv, write_csv
from tollstats.sources.lineitems import raw_records, traffic_tables
from tollstats.sources.parquet_store import ParquetStore
from tollstats.sources.staging import ensure_checkpoint_dir, remove_at_exit, staging_path

Query = Callable[[SparkSession, str], DataFrame]

# Parameters that suit the given tables.
Q2_YEAR, Q2_MORE_THAN = 1998, 250
Q3_YEAR, Q8_YEAR, Q11_YEAR, Q12_YEAR = 1998, 1999, 1998, 1997
LOADED_BEFORE = 1998
BAD_ID_EVERY, BAD_TOTAL_EVERY = 97, 89
SHORT_LINE_EVERY, LONG_LINE_EVERY, CSV_PARTS = 83, 79, 4
CHANGED_EVERY, REPEATED_EVERY, MORE_VEHICLES = 97, 89, 1000
RARE_QUANTILE = 0.9
HEAVY_CUT = 0.85
RULE, TERCILE_RULE = "regla", "regla de terciles"
# Class probabilities of the three-class rule, by tercile of light traffic.
RULE_PROBABILITIES = [[0.6, 0.3, 0.1], [0.2, 0.5, 0.3], [0.1, 0.2, 0.7]]


def _report(plan: Callable[..., DataFrame], *args, anio: int | None = None, **options) -> Query:
    """A DataFrame report; ``anio`` also narrows the scan to that year."""

    def run(spark: SparkSession, path: str) -> DataFrame:
        tables = traffic_tables(spark, path, anio)
        years = () if anio is None else (anio,)
        return plan(tables, *years, *args, **options)

    return run


def _sql_report(plan: Callable[..., DataFrame], anio: int | None = None, n: int | None = None) -> Query:
    def run(spark: SparkSession, path: str) -> DataFrame:
        years = () if anio is None else (anio,)
        return plan(traffic_tables(spark, path, anio), *years, n=n)

    return run


def _on_tables(plan: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, path: plan(traffic_tables(spark, path))


# --- reports -----------------------------------------------------------------


def q5(spark: SparkSession, path: str) -> DataFrame:
    means = reports.mean_daily_traffic(traffic_tables(spark, path))
    return means.withColumn("promedio_veh_imd", F.round("promedio_veh_imd", 6))


def q12(n: int | None = None) -> Query:
    plan = _sql_report(sqlreports.mean_by_department, Q12_YEAR, n)
    name = "promedio_veh_total"
    return lambda spark, path: plan(spark, path).withColumn(name, F.round(name, 6))


# --- load ----------------------------------------------------------------------


def _half_loaded(tables: Tables) -> DataFrame:
    """The stations taken as already stored: those with an even id."""
    return tables.peaje.where(F.col("id_peaje") % 2 == 0)


def _declared_fact(tables: Tables) -> DataFrame:
    """The fact under its declared schema, which holds every count."""
    return tables.flujo_peaje.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in FLUJO_SCHEMA]
    )


def cast_trunc(spark: SparkSession, path: str) -> DataFrame:
    items = spark.read.parquet(f"{path}/lineitem.parquet")
    price = F.when(F.col("l_linenumber") % 2 == 0, -F.col("l_extendedprice")).otherwise(
        F.col("l_extendedprice")
    )
    return items.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        to_bigint(price.cast("string")).alias("price"),
    )


def csv_scan(spark: SparkSession, path: str) -> DataFrame:
    target = staging_path(spark, "raw-csv")
    write_csv(raw_records(traffic_tables(spark, path)), target)
    remove_at_exit(spark, target)
    kinds = {c.raw: c.kind for c in [ID_COLUMN, *MEASURE_COLUMNS]}
    raw = scan_csv(spark, target)
    return raw.select(
        *[CASTS[kinds[c]](F.col(c)).alias(c) if c in kinds else F.col(c) for c in RAW_NAMES]
    )


def csv_rejected(spark: SparkSession, path: str) -> DataFrame:
    """Lines that lost fields, or have more than their header, found when the files are loaded."""
    tables = traffic_tables(spark, path)
    raw, number = raw_records(tables), F.col("ID").cast("bigint")
    fields = [F.coalesce(F.col(c), F.lit("")) for c in RAW_NAMES]
    lines = raw.select(
        F.pmod(F.xxhash64("ID"), F.lit(CSV_PARTS)).alias("part"),
        F.lit(1).alias("place"),
        F.when(number % SHORT_LINE_EVERY == 0, F.concat_ws(",", *fields[:-2]))
        .when(number % LONG_LINE_EVERY == 0, F.concat_ws(",", *fields, F.lit("1"), F.lit("2")))
        .otherwise(F.concat_ws(",", *fields))
        .alias("line"),
    )
    headers = spark.range(CSV_PARTS).select(F.col("id").alias("part"), F.lit(0).alias("place"), F.lit(",".join(RAW_NAMES)).alias("line"))
    target = staging_path(spark, "damaged-csv")
    ordered = headers.unionByName(lines).repartition("part").sortWithinPartitions("part", "place")
    ordered.select("part", "line").write.partitionBy("part").text(target)
    remove_at_exit(spark, target)
    rejected = ingest.load_rejected(scan_csv(spark, target, malformed=True), tables.peaje)
    return rejected.select(F.split_part(MALFORMED, F.lit(","), F.lit(1)).alias("ID"), F.array_join("reasons", ",").alias("reasons"))


def load_conflicts(spark: SparkSession, path: str) -> DataFrame:
    """What a load leaves out when records changed since an earlier load, or come twice."""
    tables = traffic_tables(spark, path)
    root = staging_path(spark, "load-conflicts")
    store = ParquetStore(spark, root)
    store.append_peaje(tables.peaje)
    remove_at_exit(spark, root)
    store.append_flujo(_declared_fact(tables).where(F.col("anio") < LOADED_BEFORE))
    raw, number = raw_records(tables), F.col("ID").cast("bigint")

    def more(n: int) -> Column:
        return F.concat((to_bigint(F.col("VEH_TOTAL")) + n).cast("string"), F.lit(".0"))

    changed = raw.withColumn("VEH_TOTAL", F.when(number % CHANGED_EVERY == 0, more(1)).otherwise(F.col("VEH_TOTAL")))
    repeated = raw.where(number % REPEATED_EVERY == 0).withColumn("VEH_TOTAL", more(MORE_VEHICLES))
    rejected = ingest.load(store, changed.unionByName(repeated))
    return rejected.select(
        to_bigint(F.col("ID")).alias("id_flujo"),
        to_bigint(F.col("VEH_TOTAL")).alias("veh_total"),
        F.array_join("reasons", ",").alias("reasons"),
    )


def fact_new_pruned(spark: SparkSession, path: str) -> DataFrame:
    """A year's batch against a store that holds earlier years and half of that year."""
    tables = traffic_tables(spark, path)
    root = staging_path(spark, "fact-new")
    store, fact, year = ParquetStore(spark, root), _declared_fact(tables), F.col("anio")
    store.append_flujo(fact.where((year < LOADED_BEFORE) | ((year == LOADED_BEFORE) & (F.col("id_flujo") % 2 == 0))))
    remove_at_exit(spark, root)
    batch = fact.where(year == LOADED_BEFORE)
    return ingest.fact_new(batch, store.flujo_peaje(), ingest.batch_bounds(batch), fixed_years=True)


def dim_new(tables: Tables) -> DataFrame:
    return ingest.dim_new(ingest.dim_extract(raw_records(tables)), _half_loaded(tables))


def dim_new_count(tables: Tables) -> DataFrame:
    return dim_new(tables).agg(F.count("*").alias("new_stations"))


def surrogate_ids(tables: Tables) -> DataFrame:
    return assign_ids(ingest.dim_extract(raw_records(tables)), STATION_KEY, "id_peaje")


def fact_lookup(tables: Tables) -> DataFrame:
    return ingest.fact_lookup(ingest.fact_typed(raw_records(tables)), _half_loaded(tables))


def fact_rejected(tables: Tables) -> DataFrame:
    return ingest.fact_rejected(ingest.fact_typed(raw_records(tables)), _half_loaded(tables))


def load_rejected(tables: Tables) -> DataFrame:
    """What a load of damaged records leaves out: some ids and some totals cannot be read."""
    raw, number = raw_records(tables), F.col("ID").cast("bigint")
    damaged = raw.withColumns(
        {
            "ID": F.when(number % BAD_ID_EVERY == 0, F.concat(F.lit("x"), "ID")).otherwise(F.col("ID")),
            "VEH_TOTAL": F.when(number % BAD_TOTAL_EVERY == 0, F.lit("NaN")).otherwise(F.col("VEH_TOTAL")),
        }
    )
    rejected = ingest.load_rejected(damaged, _half_loaded(tables))
    return rejected.select("ID", F.array_join("reasons", ",").alias("reasons"))


def fact_new(tables: Tables) -> DataFrame:
    stored = tables.flujo_peaje.where(F.col("anio") < LOADED_BEFORE)
    return ingest.fact_new(tables.flujo_peaje, stored)


def dedup_by_year(tables: Tables) -> DataFrame:
    """One row per station and year: the year's months share an id."""
    yearly = tables.flujo_peaje.select(
        (F.col("id_peaje") * 10000 + F.col("anio")).alias("id_flujo"), "mes", "veh_total", "veh_imd"
    )
    return dedup_key(yearly, "id_flujo")


def load_dim(spark: SparkSession, path: str) -> DataFrame:
    tables = traffic_tables(spark, path)
    root = staging_path(spark, "load-dim")
    store = ParquetStore(spark, root)
    store.append_peaje(_half_loaded(tables))
    remove_at_exit(spark, root)
    ingest.load_dim(store, raw_records(tables))
    return store.peaje()


def load_fact(spark: SparkSession, path: str) -> DataFrame:
    tables = traffic_tables(spark, path)
    root = staging_path(spark, "load-fact")
    store = ParquetStore(spark, root)
    store.append_peaje(tables.peaje)
    store.append_flujo(_declared_fact(tables).where(F.col("anio") < LOADED_BEFORE))
    remove_at_exit(spark, root)
    ingest.load_fact(store, raw_records(tables))
    return store.flujo_peaje()


def parquet_append(spark: SparkSession, path: str) -> DataFrame:
    tables = traffic_tables(spark, path)
    root = staging_path(spark, "append")
    store = ParquetStore(spark, root)
    fact = _declared_fact(tables)
    store.append_flujo(fact.where(F.col("anio") < LOADED_BEFORE))
    store.append_flujo(fact.where(F.col("anio") >= LOADED_BEFORE))
    remove_at_exit(spark, root)
    return store.flujo_peaje()


# --- expressions, statistics, sampling -----------------------------------------


def fillna_numeric(tables: Tables) -> DataFrame:
    holed = reports.joined_records(tables).select(
        "id_flujo",
        F.nullif(F.col("veh_ligeros_total"), F.lit(0)).alias("veh_ligeros_total"),
        F.nullif(F.col("veh_imd"), F.lit(1.0)).alias("veh_imd"),
        F.nullif(F.col("departamento"), F.lit("NATION_3")).alias("departamento"),
    )
    return holed.na.fill(0)


def union_all(tables: Tables) -> DataFrame:
    rows = tables.flujo_peaje.select("id_flujo", "anio", "mes", "veh_total")
    return rows.where(F.col("anio") <= 1998).unionByName(rows.where(F.col("anio") >= 1998))


def label_median(tables: Tables) -> DataFrame:
    return features.label_median(models.staged_base(tables)).select("id_flujo", "veh_total", "label")


def label_terciles(tables: Tables) -> DataFrame:
    return features.label_terciles(models.staged_base(tables)).select(
        "id_flujo", "veh_total", "label"
    )


def oversampled(probability: float) -> Callable[[Tables], DataFrame]:
    def run(tables: Tables) -> DataFrame:
        labelled = features.label_median(models.staged_base(tables), probability=probability)
        return oversample(labelled, "label", 1.0, 0.0, copy_column="copy").select(
            "id_flujo", "veh_total", "label", "copy"
        )

    return run


def split_rows(tables: Tables) -> DataFrame:
    return tables.flujo_peaje.select("id_flujo", split_side(["id_flujo"]).alias("side"))


def split_counts(tables: Tables) -> DataFrame:
    return split_rows(tables).groupBy("side").count()


# --- features -------------------------------------------------------------------


def string_index(tables: Tables) -> DataFrame:
    base = models.staged_base(tables)
    indexed = features.string_indexer().fit(base).transform(base)
    pairs = [
        F.struct(
            F.lit(c).alias("category"),
            F.col(c).alias("label_value"),
            F.col(f"{c}_idx").alias("label_index"),
        )
        for c in features.CATEGORIES
    ]
    return indexed.select(F.inline(F.array(*pairs))).distinct()


def one_hot(tables: Tables) -> DataFrame:
    base = models.staged_base(tables)
    indexed = features.string_indexer().fit(base).transform(base)
    encoded = features.one_hot_encoder().fit(indexed).transform(indexed)
    department, administration = (
        features.vector_entries(encoded, "id_flujo", f"{c}_vec").withColumn("category", F.lit(c))
        for c in features.CATEGORIES
    )
    both = department.unionByName(administration)
    return both.select("id_flujo", "category", "position", "value")


def feature_entries(tables: Tables) -> DataFrame:
    base = models.staged_base(tables)
    frame = features.feature_pipeline().fit(base).transform(base)
    return features.vector_entries(frame, "id_flujo", "features")


# --- metrics on rule-based scorers ------------------------------------------------


def _counted(tables: Tables) -> Tables:
    """The tables with the fact's counts read once, into the shared folder: cuts, labels
    and scores all start from there."""
    counts = tables.flujo_peaje.select("veh_ligeros_total", "veh_pesados_total", "veh_total")
    ensure_checkpoint_dir(counts.sparkSession)
    return Tables(tables.peaje, counts.checkpoint())


def rule_scores(tables: Tables) -> DataFrame:
    """Two-class scores by the share of heavy vehicles, against the median label."""
    labelled = features.label_median(tables.flujo_peaje)
    heavy = F.col("veh_pesados_total") / F.col("veh_total")
    return labelled.select(
        F.lit(RULE).alias("modelo"),
        "label",
        F.when(heavy >= HEAVY_CUT, 1.0).otherwise(0.0).alias("prediction"),
        F.array(1.0 - heavy, heavy).alias("probability"),
    )


def tercile_rule_scores(tables: Tables) -> DataFrame:
    """Three-class scores by the tercile of light traffic, against that of all traffic."""
    by_light = features.label_terciles(tables.flujo_peaje, "veh_ligeros_total")
    by_light = by_light.withColumnRenamed("label", "prediction")
    labelled = features.label_terciles(by_light)
    rows = F.array(*[F.array(*[F.lit(p) for p in row]) for row in RULE_PROBABILITIES])
    return labelled.select(
        F.lit(TERCILE_RULE).alias("modelo"),
        "label",
        "prediction",
        F.get(rows, F.col("prediction").cast("int")).alias("probability"),
    )


def _rule_losses(tables: Tables, compat: bool = False) -> DataFrame:
    return models.with_loss(rule_scores(tables), models.BINARY_CLASSES, compat)


def _tercile_losses(tables: Tables) -> DataFrame:
    return models.with_loss(tercile_rule_scores(tables), models.TERCILE_CLASSES)


def rule_metrics(tables: Tables) -> DataFrame:
    tables = _counted(tables)
    both = _rule_losses(tables).unionByName(_tercile_losses(tables))
    table = metrics_table(both)
    return table.select("modelo", *[F.round(c, 6).alias(c) for c in table.columns[1:]])


def _metric(name: str) -> Callable[[Tables], DataFrame]:
    return lambda tables: rule_metrics(tables).select("modelo", name)


def class_recall(tables: Tables) -> DataFrame:
    tables = _counted(tables)
    both = _rule_losses(tables).unionByName(_tercile_losses(tables))
    return recall_by_class(both).withColumn("class_recall", F.round("class_recall", 6))


def rule_confusion(tables: Tables) -> DataFrame:
    tables = _counted(tables)
    return confusion_matrix(rule_scores(tables).unionByName(tercile_rule_scores(tables)))


def _mean_loss(losses: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    return lambda tables: losses(_counted(tables)).agg(F.round(F.avg("loss"), 6).alias("loss"))


# --- trained models ----------------------------------------------------------------


def _scored(name: str, binary: bool) -> Callable[[Tables], DataFrame]:
    """One model's test rows with prediction and class probabilities."""

    def run(tables: Tables) -> DataFrame:
        if binary:
            frame = models.binary_features(tables)
            model, classes = models.binary_models(frame)[name], models.BINARY_CLASSES
        else:
            frame = models.tercile_features(tables)
            model, classes = models.tercile_models(frame)[name], models.TERCILE_CLASSES
        scored = models.train_and_score(frame, {name: model})
        probabilities = [F.get("probability", F.lit(i)).alias(f"p{i}") for i in range(classes)]
        return scored.select("*", *probabilities).drop("probability")

    return run


def ml_scored_rows(tables: Tables) -> DataFrame:
    """Test rows of every model by label, and the sum of their class probabilities."""
    base = models.staged_base(tables)
    binary, terciles = models.binary_features(tables, base=base), models.tercile_features(tables, base=base)
    scored = models.train_and_score(binary, models.binary_models(binary)).unionByName(
        models.train_and_score(terciles, models.tercile_models(terciles))
    )
    mass = F.aggregate("probability", F.lit(0.0), lambda total, p: total + p)
    return scored.groupBy("modelo", "label").agg(
        F.count("*").alias("rows"), F.round(F.sum(mass), 6).alias("probability")
    )


def _by_model(rows: dict[str, DataFrame]) -> DataFrame:
    named = [frame.select(F.lit(name).alias("modelo"), *frame.columns) for name, frame in rows.items()]
    return reduce(DataFrame.unionByName, named)


def ml_optimality(tables: Tables) -> DataFrame:
    """The score equations of both regressions on their training rows, which vanish at the optimum."""
    residuals, base = {}, models.staged_base(tables)
    for name, frame, classes in (
        (models.LOGISTIC_NAME, models.binary_features(tables, base=base), [1]),
        (models.MULTINOMIAL_NAME, models.tercile_features(tables, base=base), [0, 1, 2]),
    ):
        chosen = {name: (models.logistic() if len(classes) == 1 else models.multinomial())}
        trained, train, _ = models.fitted(frame, chosen)
        probability = modelrules.logistic_probabilities(trained[name], vector_to_array("features"))
        residuals[name] = modelrules.score_equations(train, probability, classes)
    rounded = F.round("residual", 3) + 0.0  # no negative zero
    return _by_model(residuals).withColumn("residual", rounded)


def ml_tree_rules(tables: Tables) -> DataFrame:
    """Test rows of tree and forest, and on how many the node rules say otherwise."""
    frame = models.tercile_features(tables)
    chosen = {n: m for n, m in models.tercile_models(frame).items() if n != models.MULTINOMIAL_NAME}
    trained, _, test = models.fitted(frame, chosen)
    return _by_model({name: _rule_gaps(model, test, models.TERCILE_CLASSES) for name, model in trained.items()})


def ml_tree_leaves(tables: Tables) -> DataFrame:
    """Training rows by label, and how many of them the tree's leaves do not count where the rules put them."""
    frame = models.tercile_features(tables)
    trained, train, _ = models.fitted(frame, {models.TREE_NAME: models.decision_tree()})
    nodes = modelrules.tree_nodes(train.sparkSession, trained[models.TREE_NAME])
    trees = modelrules.forest_column(nodes)
    counted = modelrules.leaf_counts(train, trees, models.TREE_DEPTH)
    votes = nodes.where("left < 0").select("node", F.posexplode("votes").alias("label", "votes"))
    both = counted.join(votes.withColumn("label", F.col("label").cast("double")), ["node", "label"], "full").na.fill(0)
    wrong = F.sum(F.abs(F.col("rows") - F.col("votes"))).cast("bigint").alias("wrong")
    return both.groupBy("label").agg(F.sum("rows").alias("rows"), wrong)


def ml_mlp_forward(tables: Tables) -> DataFrame:
    """Test rows of the perceptron, and on how many the forward pass says otherwise."""
    frame = models.binary_features(tables)
    name = models.PERCEPTRON_NAME
    trained, _, test = models.fitted(frame, {name: models.binary_models(frame)[name]})
    return _by_model({name: _rule_gaps(trained[name], test, models.BINARY_CLASSES)})


def _rule_gaps(model, test: DataFrame, classes: int) -> DataFrame:
    return modelrules.rule_gaps(modelrules.with_rules(model.transform(test), model, classes))


def ml_compare_rules(tables: Tables) -> DataFrame:
    """By how much each metric of the two comparisons differs when the rules score instead of the models."""
    gaps, base = [], models.staged_base(tables)
    for frame, chosen, classes in (
        (binary := models.binary_features(tables, base=base), models.binary_models(binary), models.BINARY_CLASSES),
        (terciles := models.tercile_features(tables, base=base), models.tercile_models(terciles), models.TERCILE_CLASSES),
    ):
        trained, _, test = models.fitted(frame, chosen)
        both = []
        for name, model in trained.items():
            rows = modelrules.with_rules(model.transform(test), model, classes)
            # A row scored once counts on both sides.
            sides = F.array(
                F.struct(F.lit(False).alias("ruled"), "prediction", vector_to_array("probability").alias("probability")),
                F.struct(F.lit(True).alias("ruled"), F.col("rule_prediction").alias("prediction"), F.col("rule_probability").alias("probability")),
            )
            both.append(rows.select(F.lit(name).alias("name"), "label", F.inline(sides)))
        scored = reduce(DataFrame.unionByName, both).withColumn("modelo", F.struct("name", "ruled"))
        table = metrics_table(models.with_loss(scored, classes))

        def of(metric: str, ruled: bool) -> Column:
            return F.max(F.when(F.col("modelo.ruled") == ruled, F.col(metric)))

        differences = [F.round(F.abs(of(m, False) - of(m, True)), 6).alias(m) for m in METRICS]
        gaps.append(table.groupBy(F.col("modelo.name").alias("modelo")).agg(*differences))
    return reduce(DataFrame.unionByName, gaps)


def class_weights(tables: Tables) -> DataFrame:
    """Rows and summed weights by label, where weights take the place of copies."""
    labelled = features.label_median(models.staged_base(tables), probability=RARE_QUANTILE)
    weighted = sampling.class_weights(labelled, "label", 1.0, 0.0)
    return weighted.groupBy("label").agg(F.count("*").alias("rows"), F.sum("weight").alias("weight"))


def activity_bitmaps(tables: Tables) -> DataFrame:
    """q10 from the bitmaps that a store keeps of two loads, one of each half of the months."""
    spark = tables.peaje.sparkSession
    root = staging_path(spark, "activity")
    store = ParquetStore(spark, root)
    for half in (0, 1):
        loaded = tables._replace(flujo_peaje=tables.flujo_peaje.where(F.col("mes") % 2 == half))
        store.append_activity(activity.station_activity(loaded))
    remove_at_exit(spark, root)
    return activity.stations_per_year(store.activity())


TABLE_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "dim_extract": lambda t: ingest.dim_extract(raw_records(t)),
    "dim_new": dim_new,
    "dim_new_count": dim_new_count,
    "surrogate_ids": surrogate_ids,
    "fact_typed": lambda t: ingest.fact_typed(raw_records(t)),
    "fact_lookup": fact_lookup,
    "fact_rejected": fact_rejected,
    "load_rejected": load_rejected,
    "fact_new": fact_new,
    "dedup_key": dedup_by_year,
    "join_using": reports.joined_records,
    "fillna_numeric": fillna_numeric,
    "union_all": union_all,
    "ml_base": features.ml_base,
    "quantile_median": lambda t: exact_quantiles(features.ml_base(t), "veh_total", features.MEDIAN),
    "quantile_terciles": lambda t: exact_quantiles(
        features.ml_base(t), "veh_total", features.TERCILES
    ),
    "label_median": label_median,
    "label_terciles": label_terciles,
    "label_distribution": lambda t: features.label_distribution(label_median(t)),
    "label_distribution_terciles": lambda t: features.label_distribution(label_terciles(t)),
    "oversample": oversampled(RARE_QUANTILE),
    "oversample_median": oversampled(features.MEDIAN["mediana"]),
    "split_rows": split_rows,
    "split_counts": split_counts,
    "string_index": string_index,
    "one_hot": one_hot,
    "features": feature_entries,
    "confusion_matrix": rule_confusion,
    "metric_accuracy": _metric("accuracy"),
    "metric_recall": _metric("recall"),
    "metric_f1": _metric("f1_score"),
    "recall_by_class": class_recall,
    "logloss_binary": _mean_loss(_rule_losses),
    "logloss_binary_compat": _mean_loss(lambda t: _rule_losses(t, compat=True)),
    "logloss_multi": _mean_loss(_tercile_losses),
    "metrics_table": rule_metrics,
    "ml_lr_binary": _scored(models.LOGISTIC_NAME, binary=True),
    "ml_mlp": _scored(models.PERCEPTRON_NAME, binary=True),
    "ml_tree": _scored(models.TREE_NAME, binary=False),
    "ml_forest": _scored(models.FOREST_NAME, binary=False),
    "ml_lr_multi": _scored(models.MULTINOMIAL_NAME, binary=False),
    "ml_compare_binary": models.compare_binary,
    "ml_compare_multi": models.compare_multi,
    "ml_scored_rows": ml_scored_rows,
    "ml_optimality": ml_optimality,
    "ml_tree_rules": ml_tree_rules,
    "ml_tree_leaves": ml_tree_leaves,
    "ml_mlp_forward": ml_mlp_forward,
    "ml_compare_rules": ml_compare_rules,
    "class_weights": class_weights,
    "activity_bitmaps": activity_bitmaps,
}

QUERIES: dict[str, Query] = {
    "q1_peaje": _report(reports.station_columns),
    "q1_flujo": _report(reports.traffic_columns),
    "q2": _report(reports.busy_months, Q2_MORE_THAN, anio=Q2_YEAR),
    "q3": _report(reports.busiest_stations, anio=Q3_YEAR),
    "q4": _report(reports.stations_per_year_wide),
    "q4_long": _report(reports.stations_per_year),
    "q5": q5,
    "q6": _report(reports.monthly_traffic),
    "q7": _report(reports.light_share),
    "q8": _sql_report(sqlreports.year_by_month, Q8_YEAR),
    "q9": _sql_report(sqlreports.records_per_year),
    "q10": _sql_report(sqlreports.stations_per_year),
    "q11": _sql_report(sqlreports.year_by_traffic, Q11_YEAR),
    "q12": q12(),
    "topk_q3": _report(reports.busiest_stations, anio=Q3_YEAR, n=20),
    "topk_q6": _report(reports.monthly_traffic, n=25),
    "topk_q7": _report(reports.light_share, n=25),
    "topk_q8": _sql_report(sqlreports.year_by_month, Q8_YEAR, n=25),
    "topk_q10": _sql_report(sqlreports.stations_per_year, n=30),
    "topk_q11": _sql_report(sqlreports.year_by_traffic, Q11_YEAR, n=30),
    "topk_q12": q12(25),
    "cast_trunc": cast_trunc,
    "csv_scan": csv_scan,
    "parquet_append": parquet_append,
    "load_dim": load_dim,
    "load_fact": load_fact,
    "csv_rejected": csv_rejected,
    "load_conflicts": load_conflicts,
    "fact_new_pruned": fact_new_pruned,
    **{name: _on_tables(plan) for name, plan in TABLE_QUERIES.items()},
}
