"""Data-quality checks: split, flag, per-rule counts, rule catalogs.

Checks that need other rows are prepared with joins, never with a window
over the checked key: duplicates come from a grouped aggregate joined back
(map-side partial aggregation; AQE can split a hot key's join partition),
orphans from a join against the *distinct* related keys (no fan-out).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from ..functions import rules as R


# ------------------------------------------------------------------ helpers
def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_duplicate_marker(df: DataFrame, cols: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``name`` = true for every row of a key except exactly one: the first
    by ``order``, then by a hash of the row.

    Equivalent to ``row_number() over (partition by cols order by ...) > 1``
    without putting a whole key into one window partition: rows are numbered
    per (key, input partition), and the first ones of a key's input partitions
    are compared by a grouped aggregate (map-side partials) joined back.  Rows
    pass through unchanged, whatever their types.
    """
    part, tie, nth, first, key = (free_name(df, n) for n in ("_part", "_tie", "_nth", "_first", "_dupkey"))
    plain = [F.to_json(c) if "map<" in t else F.col(c) for c, t in df.dtypes]
    d = df.withColumns({part: F.spark_partition_id(), tie: F.xxhash64(*plain), key: F.struct(*cols)})
    w = Window.partitionBy(key, part).orderBy(*order, tie)
    d = d.withColumn(nth, F.row_number().over(w))
    rank = F.struct(*order, tie, part)
    best = d.where(F.col(nth) == 1).groupBy(key).agg(F.min(rank).alias(first))
    best = best.select(F.col(key).alias(key + "2"), first)
    j = d.join(best, F.col(key).eqNullSafe(F.col(key + "2")), "left")
    mine = (F.col(nth) == 1) & rank.eqNullSafe(F.col(first))
    return j.withColumn(name, ~mine).select(*df.columns, name)


def with_group_count(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """``name`` = rows sharing the value(s) of ``cols`` (null is a value)."""
    cnt = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))
    j = df.join(cnt, on=[df[c].eqNullSafe(cnt[c]) for c in cols], how="left")
    return j.drop(*[cnt[c] for c in cols])


def with_related_marker(df: DataFrame, col: str, related: DataFrame, related_col: str, name: str) -> DataFrame:
    """``name`` is non-null when ``col`` exists in the related table."""
    key = free_name(df, "_rk")
    keys = related.select(F.col(related_col).alias(key)).distinct().withColumn(name, F.lit(True))
    return df.join(keys, df[col] == keys[key], "left").drop(key)


def prepare(df: DataFrame, checks: Sequence[dict]) -> tuple[DataFrame, list[dict], list[str]]:
    """Add the helper columns of checks that look at other rows: (frame, checks
    that know their helpers, names of the added columns)."""
    out, added = [], []
    for chk in checks:
        chk = {**chk, "helper": {}}
        if chk["type"] == "unique_check":
            name = free_name(df, "_dup")
            df = with_duplicate_marker(df, chk["columns"], chk.get("order", chk["columns"]), name)
            chk["helper"] = {c: name for c in chk["columns"]}
        elif chk["type"] == "orphan_check" and chk.get("related") is not None:
            for c in chk["columns"]:
                chk["helper"][c] = free_name(df, "_rel")
                df = with_related_marker(df, c, chk["related"], chk["related_column"], chk["helper"][c])
        elif chk["type"] == "valid_values_check" and chk.get("values_from") is not None:
            # long value lists live in a table: membership by a join on the
            # distinct values instead of a huge IN list
            for c in chk["columns"]:
                chk["helper"][c] = free_name(df, "_val")
                df = with_related_marker(df, c, chk["values_from"], chk["values_column"], chk["helper"][c])
        added += list(dict.fromkeys(chk["helper"].values()))
        out.append(chk)
    return df, out, added


# ---------------------------------------------------------------- split checks
def flag(df: DataFrame, checks: Sequence[dict], reasons_col: str = "invalid_reasons") -> DataFrame:
    """One pass: every row gets the array of reasons it fails."""
    df, checks, added = prepare(df, checks)
    arr = F.array_compact(F.array(*[F.when(R.violation(c), F.lit(R.reason(c))) for c in checks]))
    return df.withColumn(reasons_col, arr).drop(*added)


def split(df: DataFrame, checks: Sequence[dict]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, invalid rows + invalid_reason).  Every check sees every
    row, so a row failing several checks carries all its reasons."""
    f = flag(df, checks, "_reasons")
    valid = f.where(F.size("_reasons") == 0).drop("_reasons")
    invalid = (f.where(F.size("_reasons") > 0)
               .withColumn("invalid_reason", F.array_join("_reasons", "; ")).drop("_reasons"))
    return valid, invalid


def active_passive(df: DataFrame, active: Sequence[dict], passive: Sequence[dict]) -> DataFrame:
    """Active checks block a row (``blocked``); passive ones only report."""
    f = flag(flag(df, active, "_a"), passive, "_p")
    return (f.withColumn("blocked", F.size("_a") > 0)
             .withColumn("active_reason", F.when(F.size("_a") > 0, F.array_join("_a", "; ")))
             .withColumn("passive_reason", F.when(F.size("_p") > 0, F.array_join("_p", "; ")))
             .drop("_a", "_p"))


def checks_from_rows(rows: Sequence[Row]) -> list[dict]:
    """Rule-table rows -> check configs (one check per row)."""
    out = []
    for r in rows:
        d = r.asDict()
        chk = {"type": d["rule_type"], "columns": [c.strip() for c in d["columns"].split(",")]}
        p = d.get("param")
        if chk["type"] == "range_check":
            lo, hi = (float(x) for x in p.split(":"))
            chk["rules"] = [{"type": "valid_range", "range": [lo, hi]}]
        elif chk["type"] == "datatype_check":
            chk["datatype"] = p
        elif chk["type"] == "date_format_check":
            chk["format"] = p
        elif chk["type"] == "fixed_length_check":
            chk["length"] = int(p)
        elif chk["type"] == "valid_values_check":
            chk["valid_values"] = [v.strip() for v in p.split("|")]
        elif chk["type"] == "special_character_check" and p:
            chk["pattern"] = p
        out.append(chk)
    return out


# ----------------------------------------------------------------- table rules
def prepare_table_rules(df: DataFrame, rules: Sequence[dict]) -> tuple[DataFrame, list[dict], list[str]]:
    """As :func:`prepare`, for rules of a catalog (one column each)."""
    out, added = [], []
    for r in rules:
        r = dict(r)
        if r["rule_type"] == "orphan_check":
            r["helper"] = free_name(df, "_rel")
            df = with_related_marker(df, r["column"], r["related"], r["related_column"], r["helper"])
        elif r["rule_type"] == "valid_values_check" and r.get("values_from") is not None:
            r["helper"] = free_name(df, "_val")
            df = with_related_marker(df, r["column"], r["values_from"], r["values_column"], r["helper"])
        elif r["rule_type"] == "unique_check":
            count = free_name(df, "_cnt")
            df = with_group_count(df, r.get("columns") or [r["column"]], count)
            r["helper"] = free_name(df, "_dup")
            df = df.withColumn(r["helper"], F.col(count) > 1).drop(count)
        if r.get("helper"):
            added.append(r["helper"])
        out.append(r)
    return df, out, added


def flag_rules(df: DataFrame, rules: Sequence[dict], mode: str = "valid_if",
               result_col: str = "data_quality_result_array",
               flag_col: str = "data_quality_valid_flag") -> DataFrame:
    """Rule ids of violated rules as an array, plus a Y/N valid flag."""
    df, rules, added = prepare_table_rules(df, rules)
    arr = F.array_compact(F.array(*[F.when(R.table_rule_violation(r, mode), F.lit(str(r["id"]))) for r in rules]))
    return (df.withColumn(result_col, arr)
              .withColumn(flag_col, F.when(F.size(result_col) > 0, "N").otherwise("Y"))
              .drop(*added))


def rule_columns(df: DataFrame, rules: Sequence[dict], mode: str = "valid_if", prefix: str = "rule") -> DataFrame:
    """One 0/1 column per rule, named ``<prefix>_<rel id>_<rule dim id>``."""
    df, rules, added = prepare_table_rules(df, rules)
    cols = {f"{prefix}_{r['id']}_{r['rule_dim_id']}": F.when(R.table_rule_violation(r, mode), 1).otherwise(0)
            for r in rules}
    return df.withColumns(cols).drop(*added)


def labels(df: DataFrame, rules: Sequence[dict], mode: str = "valid_if") -> DataFrame:
    df, rules, added = prepare_table_rules(df, rules)
    cols = {f"label_{r['id']}": R.label(r, R.table_rule_violation(r, mode)) for r in rules}
    return df.withColumns(cols).drop(*added)


def rule_counts(df: DataFrame, rules: Sequence[dict], mode: str = "valid_if", prefix: str = "rule") -> DataFrame:
    """Violations per rule as rows (rule_object_rel_id, rule_dim_id, violations).

    One global aggregate (sum of the 0/1 columns, map-side partials), then
    unpivot; the ids are split back out of the column names.
    """
    flagged = rule_columns(df, rules, mode, prefix)
    names = [f"{prefix}_{r['id']}_{r['rule_dim_id']}" for r in rules]
    sums = flagged.agg(*[F.sum(n).cast("bigint").alias(n) for n in names])
    long = sums.unpivot([], names, "rule_column", "violations")
    parts = F.split("rule_column", "_")
    return long.select(parts.getItem(1).cast("bigint").alias("rule_object_rel_id"),
                       parts.getItem(2).cast("bigint").alias("rule_dim_id"), "violations")


def sample_fact(df: DataFrame, rules: Sequence[dict], audit_dim_id: int, as_of, mode: str = "flag_if") -> DataFrame:
    """dq_sample_fact rows: one per rule with its violation count."""
    from ..constants import as_of_col
    c = rule_counts(df, rules, mode)
    return c.select(
        F.lit(audit_dim_id).cast("bigint").alias("audit_dim_id"), "rule_dim_id", "rule_object_rel_id",
        as_of_col(as_of).alias("dq_sample_timestamp"), F.col("violations").alias("dq_sample_result"),
        F.lit("N").alias("dq_sample_pass"), F.lit("N").alias("dq_notification_required"),
        F.lit("flaged").alias("dq_action_taken"))


def immediate_update(df: DataFrame, rules: Sequence[dict], flag_col: str = "valid_flag",
                     mode: str = "flag_if") -> DataFrame:
    """Rows failing any rule that are still valid ('Y', any case) become 'n';
    ``dq_updated`` marks them (its sum is the affected-row count)."""
    prepared, rules, added = prepare_table_rules(df, rules)
    bad = R._any([R.table_rule_violation(r, mode) for r in rules])
    hit = F.coalesce(bad & (F.upper(F.col(flag_col)) == "Y"), F.lit(False))   # a null flag is not updated
    return (prepared.withColumn("dq_updated", hit)
            .withColumn(flag_col, F.when(hit, F.lit("n")).otherwise(F.col(flag_col)))
            .drop(*added))


# -------------------------------------------------------------- rule catalogs
def value_lists(values: DataFrame, list_col: str = "list_id", value_col: str = "column_value") -> DataFrame:
    """Quoted, sorted, comma-joined values per list.

    Values are de-duplicated (map-side) before the per-list collect, so a
    list holds one entry per distinct value.
    """
    q = values.select(list_col, F.concat(F.lit("'"), F.col(value_col), F.lit("'")).alias("_q")).distinct()
    return q.groupBy(list_col).agg(F.array_join(F.sort_array(F.collect_list("_q")), ",").alias("valid_list"))


def value_list_parts(values: DataFrame, list_col: str = "list_id", value_col: str = "column_value", per_part: int | None = None) -> DataFrame:
    """``value_lists`` without a bound on a list: (list, part, valid_list), each part the quoted,
    sorted, comma-joined text of at most ``per_part`` values; parts rise with their values."""
    from . import lists
    q = values.where(F.col(value_col).isNotNull()).select(list_col, F.concat(F.lit("'"), F.col(value_col), F.lit("'")).alias("_q")).distinct()
    got = lists.parts(q, [list_col], ["_q"], per_part=per_part or lists.PER_PART)
    return got.select(list_col, "part", F.array_join(F.transform("entries", lambda x: x["_q"]), ",").alias("valid_list"))


# Parameter columns that a relation or rule row may carry.
PARAMETERS = ("regex_string", "expected_datatype", "expected_date_format", "related_table_name", "related_column_name",
              "grouping_columns")


def rule_catalog(relations: DataFrame, rule_dim: DataFrame, lists: DataFrame, implement_type: str) -> DataFrame:
    """relation ⋈ rule ⟕ value list, enabled rules of one implement type, with
    every parameter column that the two tables have; '|' in list text becomes ','."""
    j = (relations.join(rule_dim, "rule_dim_id", "inner")
         .join(lists, relations["valid_list_id"] == lists["list_id"], "left")
         .where((F.upper(F.col("enabled")) == "Y") & (F.col("implement_type") == implement_type)))
    # rule number per table: the catalog is a small control table, one row per rule
    w = Window.partitionBy("table_name").orderBy("rule_object_rel_id")
    more = [c for c in PARAMETERS if c in relations.columns or c in rule_dim.columns]
    return j.select("rule_object_rel_id", "rule_dim_id", "rule_type_desc", "table_name", "column_name",
                    "operator", "threshold_low", "threshold_high",
                    F.regexp_replace(F.col("valid_list"), r"\|", ",").alias("valid_list"), *more,
                    *(["valid_list_id"] if more else []), F.row_number().over(w).alias("rule_no"))


def rule_dicts(catalog_rows: Sequence[Row], values: DataFrame | None = None, tables: dict[str, DataFrame] | None = None,
               list_col: str = "list_id", value_col: str = "column_value") -> list[dict]:
    """Catalog rows (one per rule, few) -> rule dicts for ``flag_rules``.

    Value lists stay rows: with ``values`` (list id, value) a rule's values are
    joined, so a list may have any length and its values any character; the
    catalog's list text is only a fallback.  ``tables`` holds the related
    tables of orphan checks by name.
    """
    out = []
    for r in catalog_rows:
        d = r.asDict()
        kind = d["rule_type_desc"]
        rule = {"id": d["rule_object_rel_id"], "rule_dim_id": d["rule_dim_id"], "rule_type": kind,
                "column": d["column_name"], "operator": d.get("operator"), "low": d.get("threshold_low"),
                "high": d.get("threshold_high")}
        if kind == "valid_values_check":
            if values is not None and d.get("valid_list_id") is not None:
                mine = values.where(F.col(list_col) == F.lit(d["valid_list_id"])).select(F.col(value_col).alias("value"))
                rule.update(values_from=mine, values_column="value")
            else:
                rule["valid_values"] = [v.strip().strip("'") for v in (d.get("valid_list") or "").split(",") if v]
        elif kind == "special_character_check" and d.get("regex_string"):
            rule["pattern"] = d["regex_string"]
        elif kind == "datatype_check":
            rule["expected"] = d["expected_datatype"]
        elif kind == "date_format_check":
            rule["format"] = d["expected_date_format"]
        elif kind == "fixed_length_check":
            rule["length"] = int(d["threshold_low"])
        elif kind == "orphan_check":
            rule.update(related=(tables or {})[d["related_table_name"]], related_column=d["related_column_name"])
        elif kind == "unique_check" and d.get("grouping_columns"):
            rule["columns"] = [c.strip() for c in d["grouping_columns"].split(",")]
        out.append(rule)
    return out
