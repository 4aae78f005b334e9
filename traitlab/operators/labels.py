"""Known attribute labels from account records and questionnaires (LBL-*).

Every questionnaire attribute is the same operator over data: an answer
column, an answer -> class table, an optional class for any other
non-empty answer, and whether only single-letter answers count. The rule
tables become one literal map inside the projection (no join), and
``questionnaire_long`` labels all attributes from one scan with one
dedup shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import leading_int
from ..sources.snapshot import answered, dated_scan, not_null

# Questionnaire answer -> class.
# attribute: (answer column, {answer: class}, class of any other non-empty answer,
#             single-letter answers only)
QUESTION_RULES = {
    "education": ("q3", {"A": 0, "B": 0, "C": 0, "D": 0, "E": 1, "F": 2, "G": 2}, None, False),
    "marital": ("q4", {"A": 0, "B": 1}, None, False),
    "career": ("q6", {"A": 0, "B": 1, "C": 1, "D": 1, "E": 1, "F": 1, "G": 1, "I": 1, "J": 1,
                      "Q": 1}, None, False),
    "parent": ("q7", {"A": 1, "B": 1, "C": 1, "D": 1, "E": 1, "F": 1, "H": 0}, None, True),
    "car": ("q8", {"A": 1, "B": 0}, None, False),
    "estate": ("q9", {"A": 1, "B": 0}, None, False),
    "income": ("q10", {"A": 0}, 1, False),
    "consumption": ("q11", {"A": 0}, 1, False),
}
# Marital answers are read only when one of these.
MARITAL_SELECTED = ("A", "B", "C", "D")
# Child stage text -> class (other stages are not used).
CHILD_STAGE_RULES = {"婴幼儿": 0, "孕育期": 1, "青少年": 2}
# Account sex code -> class (2 = male -> 1, 1 = female -> 0).
GENDER_CODES = {1: 0, 2: 1}
# Age bands, inclusive (low, high) -> class.
AGE_BANDS = ((7, 14, 0), (15, 22, 1), (23, 35, 2), (36, 45, 3), (46, 76, 4))
# Fixed value: marital class from age, age <= 35 -> 0, older -> 1.
MARITAL_AGE_CUT = 35


@dataclass(frozen=True)
class AnswerRule:
    attribute: str
    column: str
    classes: dict
    default: int | None = None
    single_choice: bool = False
    selected: tuple | None = None


def answer_rule(attribute: str) -> AnswerRule:
    col, classes, default, single = QUESTION_RULES[attribute]
    selected = MARITAL_SELECTED if attribute == "marital" else None
    return AnswerRule(attribute, col, classes, default, single, selected)


def child_rule() -> AnswerRule:
    return AnswerRule("child", "child_stage", CHILD_STAGE_RULES, None, False,
                      tuple(CHILD_STAGE_RULES))


def _literal_map(pairs: dict) -> Column:
    items = []
    for k, v in pairs.items():
        items += [F.lit(k), F.lit(float(v))]
    return F.create_map(*items)


def dedup(labels: DataFrame, keys: tuple[str, ...] = ("device_id",)) -> DataFrame:
    """One label per key (AGG-1): the smallest, so reruns agree.

    ``min`` has a map-side partial aggregate: a device repeated in many rows
    reaches the shuffle once per task.
    """
    return labels.groupBy(*keys).agg(F.min("label").alias("label"))


def _rule_filter(df: DataFrame, answer: Column, rule: AnswerRule) -> DataFrame:
    df = df.where(answer != F.lit(""))
    if rule.selected is not None:
        df = df.where(answer.isin(*rule.selected))
    if rule.single_choice:
        df = df.where(F.length(answer) == 1)
    return df


def answer_labels(source: DataFrame, rule: AnswerRule, keep_all: bool = False) -> DataFrame:
    """(device_id, label) rows of one attribute before dedup (LBL-0)."""
    rows = not_null(source.select("device_id", F.col(rule.column).alias("answer")),
                    "device_id", "answer")
    rows = _rule_filter(rows, F.col("answer"), rule)
    label = F.try_element_at(_literal_map(rule.classes), F.col("answer"))
    if rule.default is not None:
        label = F.coalesce(label, F.lit(float(rule.default)))
    out = rows.select("device_id", label.alias("label"))
    return out if keep_all else out.where(F.col("label").isNotNull())


def question_label(questionnaire: DataFrame, attribute: str) -> DataFrame:
    """Deduped labels of one questionnaire attribute (LBL-4, LBL-5, LBL-7..12)."""
    return dedup(answer_labels(questionnaire, answer_rule(attribute)))


def child_label(child_stage: DataFrame) -> DataFrame:
    """LBL-6: child stage classes."""
    return dedup(answer_labels(child_stage, child_rule()))


def questionnaire_long(questionnaire: DataFrame, child_stage: DataFrame | None = None,
                       attributes: tuple[str, ...] = tuple(QUESTION_RULES),
                       raw: bool = False) -> DataFrame:
    """(attribute, device_id, label) for all questionnaire attributes.

    One scan: the answer columns are unpivoted with ``stack``, every rule
    table folds into one literal map keyed by ``attribute=answer``, and one
    shuffle dedups all attributes together (``raw=True`` leaves the dedup to
    the caller's own aggregate).
    """
    rules = [answer_rule(a) for a in attributes]
    parts = []
    if rules:
        pairs = ", ".join(f"'{r.attribute}', {r.column}" for r in rules)
        parts.append(questionnaire.selectExpr(
            "device_id", f"stack({len(rules)}, {pairs}) as (attribute, answer)"))
    if child_stage is not None:
        parts.append(child_stage.select("device_id", F.lit("child").alias("attribute"),
                                        F.col("child_stage").alias("answer")))
        rules.append(child_rule())
    long = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    long = not_null(long, "device_id", "answer").where(F.col("answer") != F.lit(""))
    # per-attribute restrictions, folded into one predicate
    keep = F.lit(True)
    for r in rules:
        cond = F.lit(True)
        if r.selected is not None:
            cond = cond & F.col("answer").isin(*r.selected)
        if r.single_choice:
            cond = cond & (F.length("answer") == 1)
        keep = F.when(F.col("attribute") == r.attribute, cond).otherwise(keep)
    long = long.where(keep)
    classes = {f"{r.attribute}={a}": c for r in rules for a, c in r.classes.items()}
    defaults = {r.attribute: r.default for r in rules if r.default is not None}
    label = F.try_element_at(_literal_map(classes),
                             F.concat_ws("=", F.col("attribute"), F.col("answer")))
    if defaults:
        label = F.coalesce(label, F.try_element_at(_literal_map(defaults), F.col("attribute")))
    labelled = long.select("attribute", "device_id", label.alias("label")).where(
        F.col("label").isNotNull())
    return labelled if raw else dedup(labelled, ("attribute", "device_id"))


# --- account-record labelers ------------------------------------------------

def user_devices(users: DataFrame, devices: DataFrame, job_date: int,
                 user_cols: list[str], user_filter: Column | None = None) -> DataFrame:
    """Dated users joined to the dated device relation on the user id (JOIN-1).

    Both sides are filtered in their own scans before the join; Catalyst
    picks broadcast or sort-merge from sizes, and AQE revisits the choice
    from runtime statistics.
    """
    u = dated_scan(users, job_date, ["user_id", *user_cols])
    if user_filter is not None:
        u = u.where(user_filter)
    d = dated_scan(devices, job_date, ["uid", "device_id"])
    return u.join(d, u["user_id"] == d["uid"], "inner").drop("uid")


def gender_rows(users: DataFrame, devices: DataFrame, job_date: int) -> DataFrame:
    sex = F.col("sex").try_cast("int")
    joined = user_devices(users, devices, job_date, ["sex"], sex.isin(*GENDER_CODES))
    joined = not_null(joined, "device_id", "sex")
    label = F.try_element_at(_literal_map(GENDER_CODES), F.col("sex").try_cast("int"))
    return joined.select("device_id", label.alias("label"))


def gender_label(users: DataFrame, devices: DataFrame, job_date: int) -> DataFrame:
    """LBL-1: account sex of the device's user."""
    return dedup(gender_rows(users, devices, job_date))


def age_band(age: Column) -> Column:
    out = None
    for low, high, cls in AGE_BANDS:
        cond = age.between(low, high)
        out = F.when(cond, F.lit(float(cls))) if out is None else out.when(cond, F.lit(float(cls)))
    return out


def age_rows(users: DataFrame, devices: DataFrame, job_date: int) -> DataFrame:
    joined = user_devices(users, devices, job_date, ["birthdate"],
                          F.length("birthdate") > 0)
    joined = not_null(joined, "device_id", "birthdate")
    age = F.lit(int(str(job_date)[:4])) - leading_int(F.trim("birthdate"), 4)
    out = joined.select(F.trim("device_id").alias("device_id"), age_band(age).alias("label"))
    return out.where(F.col("label").isNotNull())


def age_label(users: DataFrame, devices: DataFrame, job_date: int,
              deduplicate: bool = True) -> DataFrame:
    """LBL-2: age band from the birth year; ``deduplicate=False`` keeps every
    (device, user) pair as the original did."""
    rows = age_rows(users, devices, job_date)
    return dedup(rows) if deduplicate else rows


def marital_from_age(age_collect: DataFrame, job_date: int) -> DataFrame:
    """LBL-3: marital class from a collected age (columns 0 and 2 by position)."""
    from ..sources.snapshot import by_position
    dated = age_collect.where(F.col("stat_date") == F.lit(int(job_date)))
    rows = by_position(dated, {0: "device_id", 2: "age"})
    age = F.col("age").try_cast("int")
    label = F.when(age <= MARITAL_AGE_CUT, F.lit(0.0)).when(age > MARITAL_AGE_CUT, F.lit(1.0))
    out = not_null(rows, "device_id").select("device_id", label.alias("label"))
    return dedup(out.where(F.col("label").isNotNull()))


# --- distributions -------------------------------------------------------------

def distribution(labels: DataFrame, label_col: str = "label") -> DataFrame:
    """(label, n, total, ratio) per class (AGG-3 / AGG-4, any label type).

    Counts are partially aggregated per class; the total is a window over
    the class rows alone, so counts and total come from one execution.
    """
    per = labels.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return (per.withColumn("total", total.cast("long"))
            .select("label", "n", "total", F.try_divide("n", "total").alias("ratio")))


def answered_rows(questionnaire: DataFrame, column: str) -> DataFrame:
    return answered(questionnaire.select("device_id", column), column)
