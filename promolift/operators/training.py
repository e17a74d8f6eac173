"""Training frames (W9, W12-W15, P2 frame, P10, P11, F11).

Global "top-n by recency" and "first 60 % by week" are positional over the whole
frame.  Instead of a window over one global partition, the rank is resolved from
per-week row counts (one small row per calendar week, collected) and a row number
*within* the boundary week only, ordered by id for determinism.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import CAMPAIGN_FLAGS, CATEGORY_FEATURES

# Fixed values from the modelled pipeline.
BASELINE_MULTIPLE = 5
TRAIN_RATIO, VAL_RATIO = 0.60, 0.20

COMMON_FEATURES = ["week_of_year_sin", "week_of_year_cos", "sales_lag_12w", "sales_lag_52w"]
CAMPAIGN_FEATURES = ["campaign_week_0", "campaign_week_1", "campaign_week_2", "campaign_week_3"]
COMPETITION_FEATURES = ["campaign_coverage", "n_campaign_items_in_cluster", "item_share_in_cluster",
                        "coverage_x_share"]
CLUSTER_ONLY_FEATURES = ["num_items_in_cluster"]
TARGET = "salesQuantityKgL_log"


def id_col(level: str) -> str:
    return "baseItemId" if level == "item" else "cluster1To1Id"


def week_lag_features(level: str, week: int) -> list[str]:
    if level == "cluster":
        return [f"cluster_sales_lag_week{week}", f"cluster_sales_rolling_4w_week{week}"]
    return [f"sales_lag_week{week}", f"sales_rolling_4w_week{week}",
            f"cluster_sales_lag_week{week}", f"cluster_sales_rolling_4w_week{week}"]


def feature_list(level: str, single: bool = True, week: int = 1) -> list[str]:
    """the model's feature columns."""
    f = COMMON_FEATURES + week_lag_features(level, 1 if single else week) + CAMPAIGN_FEATURES
    if single:
        f = f + ["campaign_week_number"]
    f = f + (CLUSTER_ONLY_FEATURES if level == "cluster" else CATEGORY_FEATURES + COMPETITION_FEATURES)
    if single:
        f = f + ["cwn_x_lag", "cwn_x_rolling"]
    return f


def fill_feature_nulls(df: DataFrame, level: str) -> DataFrame:
    """No feature is null: gap weeks get competition count/coverage/interaction 0
    and the item's static baseline share (1.0 when it has none)."""
    if level != "item":
        return df
    w = Window.partitionBy("baseItemId")
    share = F.coalesce(F.col("item_share_in_cluster"),
                       F.max("item_share_in_cluster").over(w), F.lit(1.0))
    return (df.withColumn("item_share_in_cluster", share)
            .fillna(0, subset=["n_campaign_items_in_cluster"])
            .fillna(0.0, subset=["campaign_coverage", "coverage_x_share"]))


def _flag_on(level: str, col: str) -> Column:
    return F.col(col) > 0 if level == "cluster" else F.col(col) == 1


def top_recent(df: DataFrame, n: int, id_c: str) -> DataFrame:
    """The ``n`` most recent rows (week desc, id asc) without a global window."""
    if n <= 0:
        return df.limit(0)
    counts = sorted(((r["week_start"], r["c"]) for r in
                     df.groupBy("week_start").agg(F.count("*").alias("c")).collect()), reverse=True)
    acc = 0
    for wk, c in counts:
        if acc + c >= n:
            rem = n - acc
            keep = df.where(F.col("week_start") > F.lit(wk))
            edge = df.where(F.col("week_start") == F.lit(wk))
            w = Window.partitionBy("week_start").orderBy(F.col(id_c))
            edge = edge.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= rem).drop("_rn")
            return keep.unionByName(edge)
        acc += c
    return df


def balanced_sample(df: DataFrame, level: str, week: int, targets: DataFrame | None = None) -> DataFrame:
    """Ids with a week-N campaign (plus targets); all their week-N campaign rows
    and at most 5x as many of their most recent baseline rows."""
    idc = id_col(level)
    col = f"campaign_week_{week}"
    ids = df.where(_flag_on(level, col)).select(idc).distinct()
    if targets is not None:
        ids = ids.unionByName(targets.select(F.col(targets.columns[0]).cast("string").alias(idc))).distinct()
    camp = df.where(_flag_on(level, col) & F.col(idc).isNotNull())   # their ids are among ``ids``
    base = df.where((F.col(col) == 0) & _flag_on(level, "campaign_week_0"))
    wanted = BASELINE_MULTIPLE * camp.count()
    return camp.unionByName(top_recent(_recent_of_ids(base, ids, wanted, idc), wanted, idc))


def _recent_of_ids(base: DataFrame, ids: DataFrame, wanted: int, id_c: str) -> DataFrame:
    """The rows of ``base`` with an id of ``ids``, of so many latest weeks that ``wanted`` are among
    them (of all weeks, if fewer): ids meet the rows of those weeks only."""
    weeks = sorted(((r["week_start"], r["c"]) for r in base.groupBy("week_start").agg(F.count("*").alias("c")).collect()), reverse=True)
    reach = 2 * wanted
    while True:
        seen, since = 0, None
        for since, c in weeks:
            seen += c
            if seen >= reach:
                break
        if since is None or since == weeks[-1][0]:
            return base.join(ids, id_c, "left_semi")
        own = base.where(F.col("week_start") >= F.lit(since)).join(ids, id_c, "left_semi")
        if own.count() >= wanted:
            return own
        reach = 4 * seen


def sample_weight(level: str, single: bool = True, week: int = 1) -> Column:
    """P10: item 3.0 on campaign else 1.0; cluster 1 + 0.5 x intensity."""
    cols = CAMPAIGN_FLAGS if single else [f"campaign_week_{week}"]
    if level == "cluster":
        w = F.lit(1.0)
        for c in cols:
            w = w + F.col(c).cast("double") * 0.5
        return w
    on = F.lit(False)
    for c in cols:
        on = on | (F.col(c) == 1)
    return F.when(on, F.lit(3.0)).otherwise(F.lit(1.0))


def week_training_frame(df: DataFrame, level: str, week: int, targets: DataFrame | None = None,
                        ratios=(TRAIN_RATIO, VAL_RATIO)) -> DataFrame:
    """P1 frame of model week N: its balanced sample (W15) with sample weights and the
    positional split by week (W12).  ``df`` has its feature nulls filled."""
    s = balanced_sample(df, level, week, targets)
    return temporal_split(s.withColumn("weight", sample_weight(level, single=False, week=week)), id_col(level), ratios)


def _split_ends(counts: list[tuple], ratios) -> tuple[int, int, list, object, object]:
    """W12 from sorted (week, rows): where 'train' and 'val' end, the (week, rows before it) that an
    end cuts, and the last weeks that are wholly 'train' and at most 'val'."""
    n = sum(c for _, c in counts)
    train_end, val_end = int(n * ratios[0]), int(n * (ratios[0] + ratios[1]))
    cut, last_train, last_val, acc = [], None, None, 0
    for wk, c in counts:
        if acc + c <= train_end:
            last_train = wk
        elif acc >= train_end and acc + c <= val_end:
            last_val = wk
        elif acc < val_end:
            cut.append((wk, acc))
        acc += c
    return train_end, val_end, cut, last_train, last_val


def week_training_frames(df: DataFrame, level: str, targets: DataFrame | None, materialize_fn, weeks=(1, 2, 3),
                         ratios=(TRAIN_RATIO, VAL_RATIO)) -> dict[int, DataFrame]:
    """``week_training_frame`` of every model week in one pass: ``df`` with its feature nulls filled
    and the ids' campaign weeks is written, then one count a calendar week tells the samples and
    splits, and one table of all weeks' rows is written.  Only rows of a sample's oldest week and of
    weeks that a split cuts are numbered, within their week."""
    idc, cols = id_col(level), df.columns
    on = {n: F.coalesce(_flag_on(level, f"campaign_week_{n}"), F.lit(False)) for n in weeks}
    plain = {n: F.coalesce((F.col(f"campaign_week_{n}") == 0) & _flag_on(level, "campaign_week_0"), F.lit(False)) for n in weeks}
    rows = fill_feature_nulls(df, level).where(F.col(idc).isNotNull())
    rows = rows.withColumns({f"_has{n}": F.max(on[n]).over(Window.partitionBy(idc)) for n in weeks})
    if targets is not None:
        t = targets.select(F.col(targets.columns[0]).cast("string").alias(idc)).distinct().withColumn("_tg", F.lit(True))
        rows = rows.join(t, idc, "left").withColumns({f"_has{n}": F.col(f"_has{n}") | F.coalesce("_tg", F.lit(False)) for n in weeks}).drop("_tg")
    rows = materialize_fn(rows)
    base = {n: plain[n] & F.col(f"_has{n}") for n in weeks}
    stats = rows.groupBy("week_start").agg(
        *[F.count_if(c[n]).alias(f"{name}{n}") for name, c in (("c", on), ("b", base)) for n in weeks]).collect()
    stats = sorted(stats, key=lambda r: r["week_start"])   # a row a calendar week
    since, left, held, place, split = {}, {}, {}, F.lit(None).cast("long"), F.lit(None).cast("string")
    edge_split, week = F.lit(None).cast("string"), F.col("week_start")
    for n in weeks:
        wanted, acc = BASELINE_MULTIPLE * sum(r[f"c{n}"] for r in stats), 0
        taken = {}
        for r in reversed(stats):
            taken[r["week_start"]] = min(r[f"b{n}"], wanted - acc)
            acc += taken[r["week_start"]]
            since[n], left[n] = r["week_start"], taken[r["week_start"]]
            if acc >= wanted:
                break
        counts = [(r["week_start"], r[f"c{n}"] + taken.get(r["week_start"], 0)) for r in stats]
        train_end, val_end, cut, last_train, last_val = _split_ends([x for x in counts if x[1]], ratios)
        before = dict(cut)   # the week in which the sample begins is numbered too
        if n in since:
            before[since[n]] = sum(c for w, c in counts if w < since[n])
        held[n] = sorted(before)
        of = F.col("model_week") == n
        for w, lo in before.items():
            place = F.when(of & (week == F.lit(w)), F.lit(lo)).otherwise(place)
        kind = F.lit("test")
        for last, name in ((last_val, "val"), (last_train, "train")):
            if last is not None:
                kind = F.when(week <= F.lit(last), name).otherwise(kind)
        split = F.when(of, kind).otherwise(split)
        pos = F.col("_place") + F.col("_pos") - 1
        edge_split = F.when(of, F.when(pos < train_end, "train").when(pos < val_end, "val").otherwise("test")).otherwise(edge_split)
    if not since:   # no row at all
        return {n: rows.select(*cols).withColumn("weight", F.lit(1.0)).withColumn("split", F.lit("train")) for n in weeks}
    own = {n: on[n] | (base[n] & (week >= F.lit(since[n]))) for n in weeks}
    each = rows.withColumn("model_week", F.explode(F.filter(F.array(*[F.when(own[n], n) for n in weeks]), lambda x: x.isNotNull())))
    pick = lambda by: F.coalesce(*[F.when(F.col("model_week") == n, by(n)) for n in weeks])
    each = each.select(*cols, "model_week", pick(lambda n: sample_weight(level, single=False, week=n)).alias("weight"),
                       pick(lambda n: on[n]).alias("_on"), place.cast("long").alias("_place"))
    edge = each.where(F.col("_place").isNotNull())
    number = lambda *by: F.row_number().over(Window.partitionBy("model_week", "week_start", *by).orderBy(idc))
    out_of = pick(lambda n: F.when(week == F.lit(since[n]), F.lit(left[n])))
    edge = edge.withColumn("_rn", number("_on")).where(F.col("_on") | out_of.isNull() | (F.col("_rn") <= out_of))
    edge = edge.withColumn("_pos", number()).withColumn("split", edge_split)
    names = [*cols, "weight", "split", "model_week"]
    frames = materialize_fn(each.where(F.col("_place").isNull()).withColumn("split", split).select(*names).unionByName(edge.select(*names)))
    return {n: frames.where(F.col("model_week") == n).drop("model_week") for n in weeks}


def pooled_training_frame(df: DataFrame, level: str, targets: DataFrame | None = None,
                          ratios=(TRAIN_RATIO, VAL_RATIO)) -> DataFrame:
    """P2 frame + W15 + W12 in one statistics job.

    Every row learns once whether its id ever had a week-N campaign (an aggregate
    joined back).  One ``groupBy(week)`` then yields, per week and per model week N,
    the campaign-row count and the eligible-baseline-row count; from those (one small
    row per week, collected) the driver finds each N's recency cutoff and the
    60/20/20 boundaries of the stacked frame.  The frame is three filtered copies of
    the data; only the cutoff week and the boundary weeks need a row number inside
    the week.  Result columns: the P2 features, ``weight``, ``model_week`` and
    ``split``."""
    idc = id_col(level)
    df = fill_feature_nulls(df, level)
    has = df.groupBy(idc).agg(*[F.max(_flag_on(level, f"campaign_week_{n}").cast("int")).alias(f"_has{n}")
                                for n in (1, 2, 3)])
    if targets is not None and level == "item":
        t = targets.select(F.col(targets.columns[0]).cast("string").alias(idc)).distinct() \
            .withColumn("_tg", F.lit(1))
        has = has.join(t, idc, "left")
        for n in (1, 2, 3):
            has = has.withColumn(f"_has{n}", F.greatest(F.col(f"_has{n}"), F.coalesce(F.col("_tg"), F.lit(0))))
        has = has.drop("_tg")
    # one materialised copy: the three samples and the split below all read it
    from ..session import cut_lineage
    d = cut_lineage(df.join(has, idc, "left"), f"{level}-train-base")
    camp = {n: (F.col(f"_has{n}") == 1) & _flag_on(level, f"campaign_week_{n}") for n in (1, 2, 3)}
    base = {n: (F.col(f"_has{n}") == 1) & (F.col(f"campaign_week_{n}") == 0) & _flag_on(level, "campaign_week_0")
            for n in (1, 2, 3)}
    stats = d.groupBy("week_start").agg(
        *[F.sum(camp[n].cast("int")).alias(f"c{n}") for n in (1, 2, 3)],
        *[F.sum(base[n].cast("int")).alias(f"b{n}") for n in (1, 2, 3)]).collect()
    stats = sorted(stats, key=lambda r: r["week_start"])
    week_rows = {r["week_start"]: 0 for r in stats}
    parts = []
    for n in (1, 2, 3):
        k = BASELINE_MULTIPLE * sum(r[f"c{n}"] for r in stats)
        acc, cutoff, rem = 0, None, 0
        for r in reversed(stats):
            b = r[f"b{n}"]
            if cutoff is None and acc + b >= k:
                cutoff, rem = r["week_start"], k - acc
                week_rows[r["week_start"]] += rem
            elif cutoff is None:
                week_rows[r["week_start"]] += b
            acc += b
            week_rows[r["week_start"]] += r[f"c{n}"]
        bsel = d.where(base[n])
        if cutoff is not None:
            w = Window.partitionBy("week_start").orderBy(F.col(idc))
            edge = (bsel.where(F.col("week_start") == F.lit(cutoff))
                    .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= rem).drop("_rn"))
            bsel = bsel.where(F.col("week_start") > F.lit(cutoff)).unionByName(edge)
        s = d.where(camp[n]).unionByName(bsel).withColumn("model_week", F.lit(n))
        s = s.withColumn("campaign_week_number",
                         F.when(_flag_on(level, f"campaign_week_{n}"), F.lit(n)).otherwise(F.lit(0)))
        for src, dst in zip(week_lag_features(level, n), week_lag_features(level, 1)):
            if src != dst:
                s = s.withColumn(dst, F.col(src))
        parts.append(s)
    out = parts[0].unionByName(parts[1]).unionByName(parts[2]).drop("_has1", "_has2", "_has3")
    lag, roll = week_lag_features(level, 1)[:2]
    out = (out.withColumn("cwn_x_lag", F.col("campaign_week_number") * F.col(lag))
           .withColumn("cwn_x_rolling", F.col("campaign_week_number") * F.col(roll))
           .withColumn("weight", sample_weight(level)))
    # W12 on the stacked frame from the known per-week row counts
    n_all = sum(week_rows.values())
    train_end, val_end = int(n_all * ratios[0]), int(n_all * (ratios[0] + ratios[1]))
    offsets, acc = [], 0
    for wk in sorted(week_rows):
        offsets.append((wk, acc, acc + week_rows[wk]))
        acc += week_rows[wk]
    whole = {wk: ("train" if hi <= train_end else "val" if lo >= train_end and hi <= val_end
                  else "test" if lo >= val_end else None) for wk, lo, hi in offsets}
    labelled = [x for wk, lab in whole.items() if lab for x in (F.lit(wk), F.lit(lab))]
    boundary = [x for wk, lo, _ in offsets if whole[wk] is None for x in (F.lit(wk), F.lit(lo))]
    simple = F.create_map(*labelled)[F.col("week_start")] if labelled else F.lit(None).cast("string")
    out = out.withColumn("split", simple)
    if not boundary:
        return out
    known = out.where(F.col("split").isNotNull())
    edge = out.where(F.col("split").isNull())
    w = Window.partitionBy("week_start").orderBy(idc, "campaign_week_number", "model_week")
    pos = F.create_map(*boundary)[F.col("week_start")] + F.row_number().over(w) - 1
    edge = edge.withColumn("split", F.when(pos < train_end, "train").when(pos < val_end, "val").otherwise("test"))
    return known.unionByName(edge)


def temporal_split(df: DataFrame, id_c: str, ratios=(TRAIN_RATIO, VAL_RATIO),
                   tiebreak: list[str] | None = None) -> DataFrame:
    """Rows ordered by week (ties by id) get 'train' for the first int(n*0.6),
    'val' up to int(n*0.8), 'test' after.  Per-week counts are collected (one row per
    week); only the boundary weeks need a row number within the week."""
    tiebreak = tiebreak or [id_c]
    counts = sorted((r["week_start"], r["c"]) for r in
                    df.groupBy("week_start").agg(F.count("*").alias("c")).collect())
    n = sum(c for _, c in counts)
    train_end, val_end = int(n * ratios[0]), int(n * (ratios[0] + ratios[1]))
    whole, boundary, acc = [], [], 0
    for wk, c in counts:
        label = ("train" if acc + c <= train_end else "val" if acc >= train_end and acc + c <= val_end
                 else "test" if acc >= val_end else None)
        if label:
            whole += [F.lit(wk), F.lit(label)]
        else:
            boundary += [F.lit(wk), F.lit(acc)]
        acc += c
    if not counts:
        return df.withColumn("split", F.lit("train"))
    out = df.withColumn("split", F.create_map(*whole)[F.col("week_start")] if whole else F.lit(None).cast("string"))
    if not boundary:
        return out
    w = Window.partitionBy("week_start").orderBy(*tiebreak)
    pos = F.create_map(*boundary)[F.col("week_start")] + F.row_number().over(w) - 1
    edge = out.where(F.col("split").isNull()).withColumn(
        "split", F.when(pos < train_end, "train").when(pos < val_end, "val").otherwise("test"))
    return out.where(F.col("split").isNotNull()).unionByName(edge)


def cutoff_split(df: DataFrame, cutoff, date_col: str = "week_start") -> DataFrame:
    """Train before the cutoff date, test on/after."""
    from ..functions.dates import lit_date
    return df.withColumn("split", F.when(F.col(date_col) < lit_date(cutoff), "train").otherwise("test"))


def fold_cutoffs(weeks: list, n_folds: int = 3) -> list[tuple]:
    """(fold, last training week, last validation week) from the sorted distinct weeks,
    cut into n + 1 equal segments."""
    n = len(weeks)
    size = n // (n_folds + 1)
    return [(k, weeks[min((k + 1) * size, n - 1)], weeks[min((k + 2) * size, n - 1)]) for k in range(n_folds if n else 0)]


def walk_forward_folds(df: DataFrame, n_folds: int = 3) -> DataFrame:
    """Fold k trains on weeks up to and including cut k and validates on
    (cut k, cut k+1].  The data with ``fold`` and ``role``, a row for each fold."""
    weeks = [r[0] for r in df.select("week_start").distinct().orderBy("week_start").collect()]
    folds = F.array(*[F.struct(F.lit(k).alias("fold"), F.lit(a).alias("_a"), F.lit(b).alias("_b"))
                      for k, a, b in fold_cutoffs(weeks, n_folds)])
    if not weeks:
        return df.withColumn("fold", F.lit(0)).withColumn("role", F.lit("train"))
    out = df.withColumn("_f", F.explode(folds)).where(F.col("week_start") <= F.col("_f._b"))
    role = F.when(F.col("week_start") <= F.col("_f._a"), "train").otherwise("val")
    return out.select(*df.columns, F.col("_f.fold").alias("fold"), role.alias("role"))


def hash_split(df: DataFrame, keys: list[str], seed: int = 42, ratios=(TRAIN_RATIO, VAL_RATIO)) -> DataFrame:
    """Stable random 60/20/20 split from an md5 of seed and keys (not randomSplit)."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]).cast("binary"))
    b = F.conv(F.substring(digest, 1, 7), 16, 10).cast("long") % 100
    t, v = round(ratios[0] * 100), round((ratios[0] + ratios[1]) * 100)
    return df.withColumn("split", F.when(b < t, "train").when(b < v, "val").otherwise("test"))


def horizon_targets(df: DataFrame, id_c: str, y: str, h: int) -> DataFrame:
    """target = value h rows ahead within the id; rows without one dropped."""
    w = Window.partitionBy(id_c).orderBy("week_start")
    return df.withColumn("target", F.lead(y, h).over(w)).where(F.col("target").isNotNull())
