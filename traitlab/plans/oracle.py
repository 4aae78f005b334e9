"""DuckDB statements equal to the registered Spark queries.

They run on the driver tables only: every derived input view is inlined as
a CTE from :mod:`traitlab.sources.fixtures`. Only the test driver uses
these texts; the library never runs DuckDB.
"""

from __future__ import annotations

from .. import constants as C
from ..sources.fixtures import duck_with

D = C.SAMPLE_JOB_DATE
DIM = C.FEATURE_DIM


def catalog_ctes(catalog_view: str = "app_catalog") -> list[tuple[str, str]]:
    return [
        ("cat_rows", f"""select appid, app_name, installnum from {catalog_view}
            where stat_date = {D} and appid is not null and app_name is not null
              and installnum is not null"""),
        ("cat_dedup", """select appid, app_name, installnum from (
            select *, row_number() over (partition by appid order by installnum desc, app_name asc) as rn
            from cat_rows) t where rn = 1"""),
        ("cat_ranked", """select appid, app_name, installnum,
            cast(row_number() over (order by installnum desc, appid asc) - 1 as bigint) as idx
            from cat_dedup"""),
    ]


def items_ctes(installs_view: str, prefix: str, tag: str = "") -> list[tuple[str, str]]:
    """Per-device catalog hits: ``hits{tag}`` (device_id, idx, token) and
    ``devs{tag}`` (device_id, n_items) including devices without a hit."""
    return [
        (f"lookup{tag}", f"""select '{prefix}' || appid as key, idx,
            '[' || '{prefix}' || appid || '_' || app_name || '{C.TOKEN_INDEX_SEP}' || cast(idx as varchar) || ':1' as token
            from cat_ranked"""),
        (f"inst{tag}", f"""select device_id, value from {installs_view}
            where stat_date = {D} and device_id is not null and value is not null"""),
        (f"toks{tag}", f"""select device_id, split_part(tok, ':', 1) as key from (
            select device_id, unnest(string_split(regexp_replace(value, '( )+$', ''), ' ')) as tok
            from inst{tag}) t"""),
        (f"hits{tag}", f"""select distinct t.device_id, l.idx, l.token
            from toks{tag} t join lookup{tag} l on t.key = l.key"""),
        (f"devs{tag}", f"""select d.device_id, count(h.idx) as n_items
            from (select distinct device_id from inst{tag}) d
            left join hits{tag} h on d.device_id = h.device_id group by d.device_id"""),
        (f"feats{tag}", f"""select device_id, string_agg(token, ' ' order by idx) as feature
            from hits{tag} group by device_id"""),
    ]


def parse_ctes(features: str, tag: str = "") -> list[tuple[str, str]]:
    """``parsed{tag}`` (device_id, idx, value): valid tokens of a feature string."""
    return [
        (f"ptok{tag}", f"""select device_id, trim(tok) as t from (
            select device_id, unnest(string_split(feature, ' ')) as tok from {features}) x"""),
        (f"piv{tag}", f"""select device_id, string_split(regexp_replace(t, ':+$', ''), ':') as iv
            from ptok{tag}"""),
        (f"pparts{tag}", f"""select device_id, iv,
            string_split(regexp_replace(trim(iv[1]), '({C.INDEX_MARKER})+$', ''), '{C.INDEX_MARKER}') as parts
            from piv{tag} where len(iv) = 2"""),
        (f"pvals{tag}", f"""select device_id, try_cast(parts[2] as integer) as idx,
            try_cast(trim(iv[2]) as double) as value from pparts{tag} where len(parts) = 2"""),
        (f"parsed{tag}", f"""select device_id, idx, value from pvals{tag}
            where idx is not null and value is not null and idx >= 0 and idx < {DIM}"""),
    ]


def _q(views: tuple[str, ...], ctes: list[tuple[str, str]], body: str) -> str:
    return duck_with(*views, extra=ctes) + body.strip()


def feature_ctes() -> list[tuple[str, str]]:
    return catalog_ctes() + items_ctes("user_installs", C.ITEM_PREFIX)


FEATURE_VIEWS = ("app_catalog", "user_installs")


def build() -> dict[str, str]:
    o: dict[str, str] = {}

    # --- catalog --------------------------------------------------------
    o["catalog_max_installs"] = _q(("app_catalog",), catalog_ctes(),
                                   "select appid, app_name, installnum from cat_dedup")
    o["catalog_index"] = _q(("app_catalog",), catalog_ctes(),
                            "select appid, app_name, installnum, idx from cat_ranked")
    o["catalog_topk"] = _q(("app_catalog",), catalog_ctes(),
                           f"select appid, app_name, installnum, idx from cat_ranked where idx < {C.TOP_K}")

    # --- feature encode -------------------------------------------------
    o["tokens_exploded"] = _q(("user_installs",), [],
                              f"""select device_id, split_part(tok, ':', 1) as key from (
            select device_id, unnest(string_split(regexp_replace(value, '( )+$', ''), ' ')) as tok
            from user_installs where stat_date = {D} and device_id is not null and value is not null) t""")
    o["join_install_catalog"] = _q(FEATURE_VIEWS, feature_ctes(),
                                   """select t.device_id, t.key, l.idx from toks t join lookup l on t.key = l.key""")
    o["features_encoded"] = _q(FEATURE_VIEWS, feature_ctes(), "select device_id, feature from feats")
    o["features_encoded_push"] = _q(("app_catalog", "user_installs_push"),
                                    catalog_ctes() + items_ctes("user_installs_push", ""),
                                    "select device_id, feature from feats")
    o["install_coverage"] = _q(FEATURE_VIEWS, feature_ctes(), """select count(*) as n_total,
            count(*) filter (where n_items = 0) as n_empty,
            count(*) filter (where n_items > 0) as n_refined from devs""")
    o["install_length_stats"] = _q(FEATURE_VIEWS, feature_ctes(), """select
            cast(min(n_items) filter (where n_items > 0) as bigint) as min_items,
            cast(max(n_items) filter (where n_items > 0) as bigint) as max_items from devs""")
    o["features_parsed"] = _q(FEATURE_VIEWS, feature_ctes() + parse_ctes("feats"),
                              "select device_id, idx, value from parsed")
    _labels(o)
    _dataset(o)
    _metrics(o)
    _misc(o)
    return o


# The answer rules written out on their own, so that a wrong table in the
# labelers shows: attribute -> (source, label expression, condition).
ANSWER_SQL = {
    "education": ("questionnaire", """case when q3 in ('A', 'B', 'C', 'D') then 0.0e0
        when q3 = 'E' then 1.0e0 when q3 in ('F', 'G') then 2.0e0 end""", "q3 <> ''"),
    "marital": ("questionnaire", "case q4 when 'A' then 0.0e0 when 'B' then 1.0e0 end",
                "q4 in ('A', 'B', 'C', 'D')"),
    "career": ("questionnaire", """case when q6 = 'A' then 0.0e0
        when q6 in ('B', 'C', 'D', 'E', 'F', 'G', 'I', 'J', 'Q') then 1.0e0 end""", "q6 <> ''"),
    "parent": ("questionnaire", """case when q7 in ('A', 'B', 'C', 'D', 'E', 'F') then 1.0e0
        when q7 = 'H' then 0.0e0 end""", "length(q7) = 1"),
    "car": ("questionnaire", "case q8 when 'A' then 1.0e0 when 'B' then 0.0e0 end", "q8 <> ''"),
    "estate": ("questionnaire", "case q9 when 'A' then 1.0e0 when 'B' then 0.0e0 end", "q9 <> ''"),
    "income": ("questionnaire", "case q10 when 'A' then 0.0e0 else 1.0e0 end", "q10 <> ''"),
    "consumption": ("questionnaire", "case q11 when 'A' then 0.0e0 else 1.0e0 end", "q11 <> ''"),
    "child": ("child_stage", """case child_stage when '婴幼儿' then 0.0e0 when '孕育期' then 1.0e0
        when '青少年' then 2.0e0 end""", "child_stage in ('婴幼儿', '孕育期', '青少年')"),
}


def answer_rows_sql(attribute: str) -> str:
    """Pre-dedup (device_id, label) rows of one questionnaire attribute."""
    source, label, condition = ANSWER_SQL[attribute]
    return (f"select device_id, {label} as label from {source} "
            f"where device_id is not null and {condition}")


def _labels(o: dict[str, str]) -> None:
    from ..operators.labels import QUESTION_RULES
    o["scan_dated"] = _q(("users_info",), [], f"""select user_id, sex, birthdate from users_info
        where stat_date = {D}""")
    o["filter_not_null"] = _q(("device_rel",), [], f"""select uid, device_id from device_rel
        where stat_date = {D} and uid is not null and device_id is not null""")
    o["filter_answered"] = _q(("questionnaire",), [], "select device_id, q8 from questionnaire where q8 <> ''")
    o["filter_in_set"] = _q(("questionnaire",), [],
                            "select device_id, q4 from questionnaire where q4 in ('A', 'B', 'C', 'D')")
    o["join_user_device"] = _q(("users_info", "device_rel"), [], f"""
        select r.device_id, u.user_id, u.sex from users_info u join device_rel r on u.user_id = r.uid
        where u.stat_date = {D} and r.stat_date = {D} and u.sex in (1, 2)""")
    gender_rows = f"""select r.device_id, case when u.sex = 2 then 1.0e0 else 0.0e0 end as label
        from users_info u join device_rel r on u.user_id = r.uid
        where u.stat_date = {D} and r.stat_date = {D} and u.sex in (1, 2) and r.device_id is not null"""
    gender = f"select device_id, min(label) as label from ({gender_rows}) g group by device_id"
    o["label_gender"] = _q(("users_info", "device_rel"), [], gender)
    year = int(str(D)[:4])
    age_rows = f"""
          select trim(device_id) as device_id,
                 case when age between 7 and 14 then 0.0e0 when age between 15 and 22 then 1.0e0
                      when age between 23 and 35 then 2.0e0 when age between 36 and 45 then 3.0e0
                      when age between 46 and 76 then 4.0e0 end as label
          from (select r.device_id,
                       {year} - try_cast(trim(substr(trim(u.birthdate), 1, 4)) as integer) as age
                from users_info u join age_device_rel r on u.user_id = r.uid
                where u.stat_date = {D} and r.stat_date = {D} and length(u.birthdate) > 0
                  and r.device_id is not null and u.birthdate is not null) a"""
    o["label_age"] = _q(("users_info", "age_device_rel"), [], f"""
        select device_id, min(label) as label from ({age_rows}) b
        where label is not null group by device_id""")
    o["label_marital_age"] = _q(("age_collect",), [], f"""
        select device_id, min(label) as label from (
          select device_id, case when try_cast(age as integer) <= 35 then 0.0e0
                                 when try_cast(age as integer) > 35 then 1.0e0 end as label
          from age_collect where stat_date = {D} and device_id is not null) a
        where label is not null group by device_id""")
    for attr in QUESTION_RULES:
        o[f"label_{attr}"] = _q(("questionnaire",), [], f"""
            select device_id, min(label) as label from ({answer_rows_sql(attr)}) a
            where label is not null group by device_id""")
    o["label_child"] = _q(("child_stage",), [], f"""
        select device_id, min(label) as label from ({answer_rows_sql('child')}) a
        where label is not null group by device_id""")
    parts = " union all ".join(
        f"select '{a}' as attribute, device_id, label from ({answer_rows_sql(a)}) x{i}"
        for i, a in enumerate(list(QUESTION_RULES) + ["child"]))
    o["labels_long"] = _q(("questionnaire", "child_stage"), [], f"""
        select attribute, device_id, min(label) as label from ({parts}) u
        where label is not null group by attribute, device_id""")
    # label_matrix: every attribute's raw rows, one conditional min per attribute
    from .pipelines import ATTRIBUTES
    raw = {"gender": gender_rows, "age": age_rows}
    rows = " union all ".join(
        f"select '{a}' as attribute, device_id, label from ({raw.get(a) or answer_rows_sql(a)}) m{i}"
        for i, a in enumerate(ATTRIBUTES))
    cols = ", ".join(f"min(case when attribute = '{a}' then label end) as label_{a}"
                     for a in ATTRIBUTES)
    o["label_matrix"] = _q(("questionnaire", "child_stage", "users_info", "device_rel", "age_device_rel"), [], f"""
        select device_id, {cols} from ({rows}) u
        where label is not null group by device_id""")
    o["dedup_labels"] = _q(("questionnaire", "users_info", "device_rel"), [], f"""
        select attribute, cast(sum(n) as bigint) as n_rows, count(*) as n_devices, sum(label) as label_sum
        from (select attribute, device_id, count(*) as n, min(label) as label from (
                select 'parent' as attribute, device_id, label from ({answer_rows_sql('parent')}) p
                where label is not null
                union all select 'gender' as attribute, device_id, label from ({gender_rows}) g) u
              group by attribute, device_id) d group by attribute""")
    o["label_distribution"] = _q(("users_info", "device_rel"), [], f"""
        select label, n, cast(sum(n) over () as bigint) as total, n / sum(n) over () as ratio
        from (select label, count(*) as n from ({gender}) g group by label) c""")
    o["label_distribution_str"] = _q(("child_stage",), [], """
        select label, n, cast(sum(n) over () as bigint) as total, n / sum(n) over () as ratio
        from (select child_stage as label, count(*) as n from child_stage
              where device_id is not null and child_stage is not null group by child_stage) c""")


GENDER_ROWS = f"""select r.device_id, case when u.sex = 2 then 1.0e0 else 0.0e0 end as label
    from users_info u join device_rel r on u.user_id = r.uid
    where u.stat_date = {D} and r.stat_date = {D} and u.sex in (1, 2) and r.device_id is not null"""
GENDER = f"select device_id, min(label) as label from ({GENDER_ROWS}) g group by device_id"
BUCKET = "cast('0x' || substr(md5(cast({k} as varchar)), 1, 8) as bigint) % 100"


def gender_dataset_ctes() -> list[tuple[str, str]]:
    return feature_ctes() + parse_ctes("feats") + [
        ("gl", GENDER),
        ("pdev", "select distinct device_id from parsed"),
        ("gds", """select p.device_id, coalesce(g.label, -1.0e0) as label
            from pdev p left join gl g on p.device_id = g.device_id"""),
    ]


GENDER_DS_VIEWS = ("app_catalog", "user_installs", "users_info", "device_rel")


def _dataset(o: dict[str, str]) -> None:
    o["join_features_labels"] = _q(GENDER_DS_VIEWS, feature_ctes() + [("gl", GENDER)], """
        select f.device_id, coalesce(g.label, -1.0e0) as label from feats f left join gl g
        on f.device_id = g.device_id""")
    o["join_features_bucketed"] = _q(GENDER_DS_VIEWS, gender_dataset_ctes(), "select device_id, label from gds")
    o["split_labelled"] = _q(GENDER_DS_VIEWS, gender_dataset_ctes(), """
        select device_id, label, case when label <> -1.0e0 then 'labelled' else 'unlabelled' end as part
        from gds""")
    bucket = BUCKET.format(k="device_id")
    o["split_train_valid"] = _q(GENDER_DS_VIEWS, gender_dataset_ctes(), f"""
        select device_id, label, case when {bucket} < {C.TRAIN_PERCENT} then 'train' else 'valid' end as part
        from gds where label <> -1.0e0""")
    o["dataset_counts"] = _q(GENDER_DS_VIEWS, gender_dataset_ctes(), f"""
        select count(*) as n_total,
               count(*) filter (where label <> -1.0e0) as n_labelled,
               count(*) filter (where label = -1.0e0) as n_unlabelled,
               count(*) filter (where label <> -1.0e0 and {bucket} < {C.TRAIN_PERCENT}) as n_train,
               count(*) filter (where label <> -1.0e0 and not ({bucket} < {C.TRAIN_PERCENT})) as n_valid
        from gds""")


def cum_ctes(source: str, score: str) -> list[tuple[str, str]]:
    return [
        ("sc", f"""select {score} as score, count(*) filter (where label > 0.5e0) as tp,
            count(*) filter (where not (label > 0.5e0)) as fp from {source} group by {score}"""),
        ("cum", """select score, tp, fp,
            sum(tp) over (order by score desc rows between unbounded preceding and current row) as cum_tp,
            sum(fp) over (order by score desc rows between unbounded preceding and current row) as cum_fp
            from sc"""),
        ("tot", "select sum(tp) as p, sum(fp) as n from sc"),
    ]


HARD = ("hard", """select id, score, label,
    case when score > 0.5e0 then 1.0e0 else 0.0e0 end as prediction from scored""")


def _auc_sql() -> str:
    return """select cast(sum(cast(fp as hugeint) * (2 * cum_tp - tp)) as double)
        / cast(2 * max(p) * max(n) as double) as auc from cum, tot"""


F1_CTE = ("f1s", """select score as threshold,
    case when pr + rc = 0 then 0.0e0 else 2.0e0 * pr * rc / (pr + rc) end as f1 from (
      select score, cast(cum_tp as double) / cast(cum_tp + cum_fp as double) as pr,
             cast(cum_tp as double) / cast(p as double) as rc from cum, tot) x""")


def _metrics(o: dict[str, str]) -> None:
    v = ("scored",)
    o["roc_curve"] = _q(v, cum_ctes("scored", "score"), """
        select cast(cum_fp as double) / cast(n as double) as fpr,
               cast(cum_tp as double) / cast(p as double) as tpr from cum, tot
        union all select 0.0e0 as fpr, 0.0e0 as tpr
        union all select 1.0e0 as fpr, 1.0e0 as tpr""")
    o["auc_scores"] = _q(v, cum_ctes("scored", "score"), _auc_sql())
    o["auc_hard"] = _q(v, [HARD] + cum_ctes("hard", "prediction"), _auc_sql())
    o["accuracy"] = _q(v, [HARD], """select count(*) filter (where prediction = label) / count(*)
        as accuracy from hard""")
    o["f1_by_threshold"] = _q(v, cum_ctes("scored", "score") + [F1_CTE], "select threshold, f1 from f1s")
    o["best_threshold"] = _q(v, cum_ctes("scored", "score") + [F1_CTE],
                             "select threshold, f1 from f1s order by f1 desc, threshold desc limit 1")
    low = C.DEFAULT_THRESHOLD - C.THRESHOLD_TOLERANCE
    high = C.DEFAULT_THRESHOLD + C.THRESHOLD_TOLERANCE
    o["refined_threshold"] = _q(v, cum_ctes("scored", "score") + [F1_CTE], f"""
        select threshold as best_threshold, f1 as best_f1,
               case when threshold >= {low!r}e0 and threshold <= {high!r}e0 then threshold
                    else {C.DEFAULT_THRESHOLD!r}e0 end as threshold
        from (select threshold, f1 from f1s order by f1 desc, threshold desc limit 1) b""")
    o["confusion_counts"] = _q(v, [HARD], """select label, prediction, count(*) as n from hard
        group by label, prediction""")
    o["per_class_metrics"] = _q(v, [HARD], """
        select label, pr as precision, rc as recall,
               case when pr + rc = 0 then 0.0e0 else 2.0e0 * pr * rc / (pr + rc) end as f1
        from (select l.label,
                     case when coalesce(pp.predicted, 0) = 0 then 0.0e0
                          else cast(l.tp as double) / cast(pp.predicted as double) end as pr,
                     cast(l.tp as double) / cast(l.actual as double) as rc
              from (select label, sum(case when label = prediction then 1 else 0 end) as tp,
                           count(*) as actual from hard group by label) l
              left join (select prediction, count(*) as predicted from hard group by prediction) pp
              on l.label = pp.prediction) x""")


def _misc(o: dict[str, str]) -> None:
    o["job_date_normalise"] = _q((), [], """
        select o_orderkey, job_time,
               strftime(cast(make_date(y, 1, 1) + to_months(m - 1) + to_days(d - 1) as date), '%Y%m%d')
               as job_date
        from (select o_orderkey,
                     lpad(cast(1992 + o_orderkey % 7 as varchar), 4, '0')
                     || lpad(cast(1 + o_orderkey % 14 as varchar), 2, '0')
                     || lpad(cast(1 + o_orderkey % 35 as varchar), 2, '0') as job_time,
                     cast(1992 + o_orderkey % 7 as integer) as y, cast(1 + o_orderkey % 14 as integer) as m,
                     cast(1 + o_orderkey % 35 as integer) as d
              from orders) t""")
    o["union_known_predicted"] = _q(GENDER_DS_VIEWS, gender_dataset_ctes() + [
        ("ntok", "select device_id, count(*) as n from parsed group by device_id")], """
        select g.device_id, g.label, false as is_predicted from gds g where g.label <> -1.0e0
        union all
        select g.device_id, cast(t.n % 2 as double) as label, true as is_predicted
        from gds g join ntok t on g.device_id = t.device_id where g.label = -1.0e0""")

    o["doc_features"] = _q(("doc_catalog", "doc_items"),
                           catalog_ctes("doc_catalog") + items_ctes("doc_items", ""),
                           "select device_id, feature from feats")
    doc_ctes = catalog_ctes("doc_catalog") + items_ctes("doc_items", "")
    o["doc_catalog_topk"] = _q(("doc_catalog",), catalog_ctes("doc_catalog"),
                               f"select appid, app_name, installnum, idx from cat_ranked where idx < {C.TOP_K}")
    o["doc_catalog_topk_cut"] = o["doc_catalog_topk"].replace(f"idx < {C.TOP_K}", f"idx < {C.SMALL_K}")
    o["doc_features_parsed"] = _q(("doc_catalog", "doc_items"), doc_ctes + parse_ctes("feats"),
                                  "select device_id, idx, value from parsed")
    o["feature_vectors"] = _q(FEATURE_VIEWS, feature_ctes() + parse_ctes("feats"),
                              "select device_id, idx, sum(value) as value from parsed group by device_id, idx")
    o["features_encoded_topk"] = _q(
        FEATURE_VIEWS, [(n, q + f" where idx < {C.SMALL_K}" if n == "lookup" else q) for n, q in feature_ctes()],
        "select device_id, feature from feats")
    o["join_install_catalog_shuffled"] = o["join_install_catalog"]
    o["features_encoded_shuffled"] = o["features_encoded"]
    stats = """select 2 * count(*) as n_total, 2 * count(*) filter (where n_items = 0) as n_empty,
        2 * count(*) filter (where n_items > 0) as n_refined,
        cast(min(n_items) filter (where n_items > 0) as bigint) as min_items,
        cast(max(n_items) filter (where n_items > 0) as bigint) as max_items, '{0}' as lookup from devs"""
    o["install_stats_repeated"] = _q(FEATURE_VIEWS, feature_ctes(),
                                     stats.format("local") + " union all " + stats.format("shuffled"))
    o["union_distribution"] = _q(GENDER_DS_VIEWS, gender_dataset_ctes() + [
        ("ntok", "select device_id, count(*) as n from parsed group by device_id"),
        ("un", """select g.label from gds g where g.label <> -1.0e0 union all
            select cast(t.n % 2 as double) from gds g join ntok t on g.device_id = t.device_id
            where g.label = -1.0e0""")], """
        select label, n, cast(sum(n) over () as bigint) as total, n / sum(n) over () as ratio
        from (select label, count(*) as n from un group by label) c""")
    _known(o)
    _models(o)
    o["sink_overwrite_partition"] = _q(FEATURE_VIEWS, feature_ctes(), f"""
        select device_id, feature, {D} as stat_date from feats
        union all select device_id, feature, {D + 1} as stat_date from feats""")
    o["sink_published"] = o["sink_overwrite_partition"]
    o["sink_append_once"] = _q(FEATURE_VIEWS, feature_ctes(), f"""
        select device_id, feature, {D} as stat_date from feats
        union all select device_id, feature, {D} as stat_date from feats""")
    o["sink_fixed_files"] = _q(FEATURE_VIEWS, feature_ctes(), f"""
        select {D} as stat_date, cast({C.ORIGINAL_FILES_PER_PARTITION} as bigint) as n_files, count(*) as n_rows from feats""")
    o["scan_via_view"] = _q(("app_catalog",), catalog_ctes(), "select appid, app_name, installnum from cat_rows")
    bucket = BUCKET.format(k="d.device_id")
    o["doc_dataset_counts"] = _q(("doc_catalog", "doc_items", "doc_labels"),
                                 catalog_ctes("doc_catalog") + items_ctes("doc_items", "")
                                 + parse_ctes("feats") + [
        ("dds", """select p.device_id, coalesce(l.label, -1.0e0) as label
            from (select distinct device_id from parsed) p
            left join doc_labels l on p.device_id = l.device_id""")], f"""
        select count(*) as n_total,
               count(*) filter (where label <> -1.0e0) as n_labelled,
               count(*) filter (where label = -1.0e0) as n_unlabelled,
               count(*) filter (where label <> -1.0e0 and {bucket} < {C.TRAIN_PERCENT}) as n_train,
               count(*) filter (where label <> -1.0e0 and not ({bucket} < {C.TRAIN_PERCENT})) as n_valid
        from dds d""")


def model_ctes(classes: dict[str, int], refine: tuple[str, ...], known: str) -> list[tuple[str, str]]:
    """Training and scoring as joins and sums over ``parsed`` (device_id, idx, value).

    ``known`` has (a, device_id, label). Coefficients are whole numbers of 1e-9,
    residuals of 1e-6, one recursion step per iteration for all attributes:
    margins are a join of entries and coefficients, gradients one of entries and
    residuals. ``guess`` has (a, device_id, score, pred) of every device.
    """
    cols = ", ".join(f"('{a}', {k}, {n}, {4000.0 if n == 2 else 2000.0}e0)" for a, n in classes.items()
                     for k in (range(1, 2) if n == 2 else range(n)))
    bucket = BUCKET.format(k="device_id")
    low = C.DEFAULT_THRESHOLD - C.THRESHOLD_TOLERANCE
    high = C.DEFAULT_THRESHOLD + C.THRESHOLD_TOLERANCE
    names = ", ".join(f"'{a}'" for a in refine) or "''"
    sigmoid = "1.0e0 / (1.0e0 + exp(-greatest(least({z} / 1e9, 40.0e0), -40.0e0)))"
    return [
        ("kl", known),
        ("cols", f"select * from (values {cols}) c(a, k, classes, f)"),
        ("ent", "select device_id, idx, value from parsed"),
        ("tk", f"select a, device_id, label from kl where {bucket} < {C.TRAIN_PERCENT}"),
        ("txy", "select t.a, p.device_id, p.idx, p.value, t.label from ent p join tk t on p.device_id = t.device_id"),
        ("tn", """select device_id, sum(floor(abs(value) * 1e6 + 0.5)) as s from ent group by device_id"""),
        ("td", """select a, idx, sum(floor(abs(value) * s / 1e6 + 0.5)) as d
            from txy join tn on txy.device_id = tn.device_id group by a, idx"""),
        ("tr", f"""select 0 as t, td.a, k, classes, idx, 0.0e0 as w, 0.0e0 as v, d, f, true as live
            from td join cols on td.a = cols.a
            union all (
            with y as (select *, w + floor(cast(t as double) / cast(t + 3 as double) * (w - v) + 0.5) as y
                       from tr where live and t < {C.LR_MAX_ITER}),
            z as (select y.a, y.k, y.classes, x.device_id, x.label, sum(floor(y.y * x.value + 0.5)) as z
                  from txy x join y on x.a = y.a and x.idx = y.idx
                  group by y.a, y.k, y.classes, x.device_id, x.label),
            e as (select *, case when classes = 2 then {sigmoid.format(z="z")}
                    else exp(greatest(z / 1e9 - max(z / 1e9) over (partition by a, device_id), -40.0e0)) end as e from z),
            r as (select a, k, device_id, floor((case when classes = 2 then e
                    else e / sum(e) over (partition by a, device_id) end) * 1e6 + 0.5)
                    - case when label = k then 1e6 else 0 end as r from e),
            g as (select x.a, r.k, x.idx, sum(floor(r.r * x.value + 0.5)) as g
                  from txy x join r on x.a = r.a and x.device_id = r.device_id group by x.a, r.k, x.idx),
            n as (select y.t + 1 as t, y.a, y.k, classes, y.idx, floor(y.y - g * f / greatest(d, 1) + 0.5) as w, y.w as v, d, f
                  from y join g on y.a = g.a and y.k = g.k and y.idx = g.idx)
            select t, a, k, classes, idx, w, v, d, f, max(abs(w - v)) over (partition by a) > {C.LR_TOL * 1e9} as live
            from n)"""),
        ("wt", "select a, k, idx, w from (select *, max(t) over (partition by a) as last from tr) x where t = last"),
        ("sz", """select p.device_id, w.a, w.k, sum(floor(w.w * p.value + 0.5)) as z
            from ent p join wt w on p.idx = w.idx group by p.device_id, w.a, w.k"""),
        ("sa", """select d.device_id, c.a, c.k, c.classes, coalesce(z, 0.0e0) as z
            from (select distinct device_id from ent) d cross join cols c
            left join sz on sz.device_id = d.device_id and sz.a = c.a and sz.k = c.k"""),
        ("ss", f"""select a, device_id, floor({sigmoid.format(z="z")} * 1e6 + 0.5) / 1e6 as score from sa where classes = 2"""),
        ("vs", f"""select ss.a, score, label from ss join kl on ss.a = kl.a and ss.device_id = kl.device_id
            where ss.a in ({names}) and cast('0x' || substr(md5(ss.device_id), 1, 8) as bigint) % 100 >= {C.TRAIN_PERCENT}"""),
        ("vc", """select a, score, tp, fp, sum(tp) over w as ctp, sum(fp) over w as cfp, sum(tp) over (partition by a) as p
            from (select a, score, count(*) filter (where label > 0.5e0) as tp,
                         count(*) filter (where not (label > 0.5e0)) as fp from vs group by a, score) c
            window w as (partition by a order by score desc rows between unbounded preceding and current row)"""),
        ("vf", """select a, score, case when pr + rc = 0 then 0.0e0 else 2.0e0 * pr * rc / (pr + rc) end as f1
            from (select a, score, cast(ctp as double) / cast(ctp + cfp as double) as pr,
                         case when p = 0 then 0.0e0 else cast(ctp as double) / cast(p as double) end as rc from vc) x"""),
        ("thr", f"""select a, case when score >= {low!r}e0 and score <= {high!r}e0 then score
                else {C.DEFAULT_THRESHOLD!r}e0 end as thr
            from (select a, score, row_number() over (partition by a order by f1 desc, score desc) as rn from vf) b
            where rn = 1"""),
        ("guess", f"""select ss.a, device_id, score,
                case when score > coalesce(thr, {C.DEFAULT_THRESHOLD!r}e0) then 1.0e0 else 0.0e0 end as pred
            from ss left join thr on ss.a = thr.a
            union all
            select a, device_id, null, cast(k as double) from (
              select *, row_number() over (partition by a, device_id order by z desc, k) as rn from sa where classes > 2) m
            where rn = 1"""),
    ]


def _model_q(views: tuple[str, ...], ctes: list[tuple[str, str]], classes: dict[str, int], refine: tuple[str, ...],
             known: str, body: str) -> str:
    parts = [(n, q) for n, q in ctes + model_ctes(classes, refine, known)]
    text = _q(views, parts, body).replace("WITH ", "WITH RECURSIVE ", 1)
    # read by every step of the recursion
    for name in ("ent", "txy", "td", "cols", "kl"):
        text = text.replace(f"\n{name} AS (", f"\n{name} AS MATERIALIZED (")
    return text


_JOB_OUTPUT = f"""
    select g.device_id, g.a as attribute, coalesce(l.label, g.pred) as label, l.label is null as is_predicted,
           {D} as stat_date
    from guess g left join kl l on g.a = l.a and g.device_id = l.device_id"""
_VALIDATION = f"""
    select g.device_id, l.label, g.pred as prediction
    from guess g join kl l on g.a = l.a and g.device_id = l.device_id
    where {BUCKET.format(k="g.device_id")} >= {C.TRAIN_PERCENT}"""


def _label_body(o: dict[str, str], attribute: str) -> str:
    text = o[f"label_{attribute}"]
    return text[text.index("select device_id, min(label)"):]


def _models(o: dict[str, str]) -> None:
    """Trained models and their predictions (ML-1..5, PIPE-2..12)."""
    from .pipelines import ATTRIBUTES
    views = FEATURE_VIEWS + ("questionnaire", "child_stage", "users_info", "device_rel", "age_device_rel")
    feats = feature_ctes() + parse_ctes("feats")
    known = {a: f"select '{a}' as a, device_id, label from ({_label_body(o, a)}) l" for a in ATTRIBUTES}
    for a, spec in ATTRIBUTES.items():
        o[f"infer_{a}"] = _model_q(views, feats, {a: spec.classes}, (a,) if spec.refine else (), known[a], _JOB_OUTPUT)
    o["infer_all"] = _model_q(views, feats, {a: s.classes for a, s in ATTRIBUTES.items()},
                              tuple(a for a, s in ATTRIBUTES.items() if s.refine), " union all ".join(known.values()),
                              _JOB_OUTPUT)
    o["model_saved_and_loaded"] = _model_q(views, feats, {"gender": 2}, ("gender",), known["gender"], """
        select device_id, score, pred as label from guess where device_id not in (select device_id from kl)""")
    o["result_table"] = _model_q(views, feats, {"car": 2, "child": 3}, (), known["car"] + " union all " + known["child"],
                                 _JOB_OUTPUT)
    o["train_multiclass"] = _model_q(views, feats, {"age": 5}, (), known["age"], _VALIDATION)
    o["model_weights"] = _model_q(
        views, feats, {a: s.classes for a, s in ATTRIBUTES.items()}, (), " union all ".join(known.values()),
        """select a as attribute, cast(k as integer) as class, cast(idx as integer) as idx, cast(w as bigint) as weight
           from wt where w <> 0""")
    docs = catalog_ctes("doc_catalog") + items_ctes("doc_items", "") + parse_ctes("feats")
    quality = "select 'quality' as a, device_id, label from doc_labels"
    doc_views = ("doc_catalog", "doc_items", "doc_labels")
    o["infer_quality"] = _model_q(doc_views, docs, {"quality": 2}, ("quality",), quality, _JOB_OUTPUT)
    o["predict_unlabelled"] = _model_q(doc_views, docs, {"quality": 2}, ("quality",), quality, """
        select device_id, pred as label from guess
        where device_id not in (select device_id from kl)""")
    o["train_binary"] = _model_q(doc_views, docs, {"quality": 2}, ("quality",), quality, _VALIDATION)


def _known(o: dict[str, str]) -> None:
    """What the jobs return whatever the model: devices, known labels, and
    which labels are predicted."""
    from .pipelines import ATTRIBUTES
    views = FEATURE_VIEWS + ("questionnaire", "child_stage", "users_info", "device_rel", "age_device_rel")
    parts = []
    for a in ATTRIBUTES:
        label = o[f"label_{a}"]
        body = label[label.index("select device_id, min(label)"):]
        body = f"""select p.device_id, '{a}' as attribute, l.label, l.label is null as is_predicted
            from pdev p left join ({body}) l on p.device_id = l.device_id"""
        parts.append(body)
        o[f"infer_{a}_known"] = _q(views, feature_ctes() + parse_ctes("feats") + [
            ("pdev", "select distinct device_id from parsed")], body)
    o["infer_all_known"] = _q(views, feature_ctes() + parse_ctes("feats") + [
        ("pdev", "select distinct device_id from parsed")], " union all ".join(f"({p})" for p in parts))
    docs = catalog_ctes("doc_catalog") + items_ctes("doc_items", "") + parse_ctes("feats")
    o["infer_quality_known"] = _q(("doc_catalog", "doc_items", "doc_labels"), docs, """
        select p.device_id, 'quality' as attribute, l.label, l.label is null as is_predicted
        from (select distinct device_id from parsed) p left join doc_labels l on p.device_id = l.device_id""")
