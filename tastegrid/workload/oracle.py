"""SQL over the given tables for the registered queries (DuckDB dialect).

Feature vectors and the network are spelled out in SQL lists, independently of the
numpy code.
"""

from __future__ import annotations

from tastegrid.config import DOMAINS, TOP_N, DomainConfig, NetworkConfig
from tastegrid.workload import adapters as A
from tastegrid.workload.adapters import SQL

PACKAGES = ("0", "AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
COUNTRIES = ("C0", "C1", "C2", "C3", "C4")
BRANDS = tuple(sorted(f"Brand#{i}" for i in range(1, 26)))
TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
CATEGORIES = ("", *A.TAG_WORDS)

NUMBER = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def number(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '{NUMBER}') THEN TRY_CAST(trim({x}) AS DOUBLE) END"


def quoted(name: str) -> str:
    return '"' + name + '"'


def ctes(*parts: tuple[str, str]) -> str:
    """Where batch statistics are taken of a layer, what it is made from is read twice."""
    layers = [name.removesuffix("_m") for name, _ in parts if name.endswith("_m")]
    whole = {f"{at}_h" for at in layers} | ({"matrix", "scored"} if layers else set())
    return "WITH " + ",\n".join(
        f"{name} AS {'MATERIALIZED ' if name in whole else ''}({body})" for name, body in parts
    ) + "\n"


# -- cleaned tables --------------------------------------------------------------

USERS = ("users", SQL["users"])
CLEAN_USERS = ("clean_users", f"""
SELECT coalesce(username, '0') AS username,
  CASE WHEN regexp_full_match(coalesce(birthday, '0'), '[0-9]{{4,}}')
       THEN CAST(right(birthday, 4) AS INTEGER) ELSE {A.AS_OF_YEAR} END AS birthday,
  CASE WHEN regexp_full_match(coalesce(sex, '0'), '0+') THEN 0 ELSE 1 END AS sex,
  coalesce(package_code, '0') AS package_code
FROM users""")
CATALOGUE = ("catalogue", SQL["catalogue"])
TIMED = ("timed", f"""
SELECT * FROM (SELECT * REPLACE ({number('content_duration')} AS content_duration)
FROM catalogue) WHERE content_duration > 0""")


def clean_items(domain: DomainConfig, keep: str = "") -> tuple[str, str]:
    columns = ", ".join(quoted(c) for c in domain.item_columns)
    if "content_publish_year" not in domain.item_columns:
        return "clean_items", f"SELECT {keep} {columns} FROM timed"
    return "clean_items", f"""
SELECT {keep} {columns} FROM (
  SELECT * REPLACE (coalesce(y, (SELECT avg({number('content_publish_year[1:4]')}) FROM timed))
                    AS content_publish_year)
  FROM (SELECT *, {number('content_publish_year[1:4]')} AS y FROM timed))"""


def tables(domain: DomainConfig) -> tuple[tuple[str, str], ...]:
    return USERS, CLEAN_USERS, CATALOGUE, TIMED, clean_items(domain, "item_ord,")


LOG = {"wide": ("log", SQL["log_wide"]), "dense": ("log", SQL["log_dense"])}


def standardise(column: str, table: str) -> str:
    sd = f"(SELECT stddev_pop({column}) FROM {table})"
    return (
        f"(({column} - (SELECT avg({column}) FROM {table})) / "
        f"CASE WHEN {sd} = 0 THEN 1 ELSE {sd} END)"
    )


def labelled(domain: DomainConfig) -> tuple[str, str]:
    """Joined distinct rows with share, watch count and label."""
    conditions = []
    if domain.min_share is not None:
        conditions.append(f"coalesce(share >= {domain.min_share}, false)")
    if domain.min_count is not None:
        conditions.append(f"coalesce(watch_count >= {domain.min_count}, false)")
    return "labelled", f"""
SELECT *, CAST({' OR '.join(conditions)} AS INTEGER) AS label FROM (
  SELECT *, duration / content_duration AS share,
    CASE WHEN profile_id IS NOT NULL
         THEN count(*) OVER (PARTITION BY profile_id, content_id) END AS watch_count
  FROM (SELECT DISTINCT l.username, l.content_id, l.duration, l.profile_id,
               u.birthday, u.sex, u.package_code, i.* EXCLUDE (content_id, tag_names)
        FROM log l JOIN clean_users u ON l.username = u.username
                   JOIN clean_items i ON l.content_id = i.content_id))"""


def duration_of(domain: DomainConfig) -> str:
    return "ln(content_duration)" if domain.log_duration else "content_duration"


# -- feature vectors ---------------------------------------------------------------

def one_hot(column: str, values: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"list_transform([{listed}], lambda v: CAST({column} = v AS INTEGER)::DOUBLE)"


def user_vector() -> str:
    return (
        f"list_concat([sex::DOUBLE], {one_hot('package_code', PACKAGES)}, "
        f"[{standardise('birthday', 'clean_users')}])"
    )


def item_vector(domain: DomainConfig) -> str:
    columns = {"content_country": COUNTRIES, "VOD_CODE": BRANDS, "type_id": TYPES}
    numeric = [
        duration_of(domain) if c == "content_duration" else f"coalesce({c}::DOUBLE, 0)"
        for c in domain.numeric
    ]
    cats = ", ".join(f"'{v}'" for v in CATEGORIES)
    parts = [f"[{', '.join(numeric)}]"]
    parts += [one_hot(c, columns[c]) for c in domain.one_hot]
    parts.append(
        f"list_transform([{cats}], lambda v: CAST(list_contains("
        "string_split(coalesce(content_cate_id, ''), ','), v) AS INTEGER)::DOUBLE)"
    )
    if domain.scaled:
        parts.append(f"[{', '.join(standardise(c, 'clean_items') for c in domain.scaled)}]")
    nested = parts[0]
    for part in parts[1:]:
        nested = f"list_concat({nested}, {part})"
    return nested


def widths(domain: DomainConfig) -> tuple[int, int]:
    sizes = {"content_country": 5, "VOD_CODE": 25, "type_id": 6}
    item = len(domain.numeric) + sum(sizes[c] for c in domain.one_hot)
    return 8, item + len(CATEGORIES_USED) + len(domain.scaled)


# Categories that occur: every word of the part names and the empty one.
CATEGORIES_USED = CATEGORIES


def vectors(domain: DomainConfig) -> tuple[tuple[str, str], ...]:
    return (
        ("user_x", f"SELECT username, {user_vector()} AS u FROM clean_users"),
        ("item_x", f"SELECT content_id, item_ord, {item_vector(domain)} AS v FROM clean_items"),
    )


def training(domain: DomainConfig, form: str) -> tuple[tuple[str, str], ...]:
    return (
        *tables(domain), LOG[form], labelled(domain), *vectors(domain),
        ("matrix", """
SELECT l.username, l.content_id, l.profile_id, l.label, list_concat(u.u, i.v) AS x
FROM labelled l JOIN user_x u ON l.username = u.username
                JOIN item_x i ON l.content_id = i.content_id"""),
    )


# -- network -----------------------------------------------------------------------

def rule(tensor: int, cols: int, plus: float = 0.0, times: float = 1.0, row: str = "0") -> str:
    """One row of a weight tensor as a list."""
    value = f"(((7 * i + 13 * ({row}) + 5 * {tensor}) % 31) - 15) / 32.0::DOUBLE"
    return f"list_transform(range({cols}), lambda i: {plus} + {times} * ({value}))"


def matrix_rule(tensor: int, rows: int, cols: int) -> str:
    return f"list_transform(range({rows}), lambda j: {rule(tensor, cols, row='j')})"


def each(expression: str, size: int) -> str:
    return f"list_transform(range(1, {size} + 1), lambda k: {expression})"


def network(
    source: str, net: NetworkConfig, width: int, keep: str, last_x: bool = False,
    batch: bool = False,
) -> tuple[tuple[str, str], ...]:
    """CTEs that end in ``scored`` (keep…, score, score_deep, score_shallow); input x.

    ``last_x`` also hands over deep_x and shallow_x, the inputs of the output layer. With
    ``batch`` the rows are one training batch, normalised by their own statistics.
    """
    half = width // 2
    parts, tensor, before = [], 0, source
    carried = f"{keep}, x AS x0"
    logits = []
    for branch, layers in (("deep", net.deep_layers), ("shallow", net.shallow_layers)):
        parts.append((f"{branch}_in", f"SELECT {carried}, {'x' if branch == 'deep' else 'x0'} AS x"
                                      f" FROM {before}"))
        if branch == "deep":
            carried = f"{keep}, x0"
        before = f"{branch}_in"
        state = f"{keep}, x0" + "".join(f", {n}" for n in logits)
        for layer in range(layers):
            at = f"{branch}_{layer}"
            w = f"w_{at}"
            weights = [f"{matrix_rule(tensor, half, width)} AS w", f"{rule(tensor + 1, width)} AS b",
                       f"{rule(tensor + 2, half, plus=1.0)} AS g", f"{rule(tensor + 3, half)} AS o"]
            if net.gated:
                weights += [f"{matrix_rule(tensor + 4, half, half)} AS gw",
                            f"{rule(tensor + 5, half)} AS gb"]
            if net.batch_norm:
                weights += [f"{rule(tensor + 6, half, plus=1.0)} AS ng",
                            f"{rule(tensor + 7, half)} AS nb", f"{rule(tensor + 8, half)} AS nm",
                            f"{rule(tensor + 9, half, plus=1.0)} AS nv"]
            parts.append((w, f"SELECT {', '.join(weights)}"))
            parts.append((f"{at}_h", f"SELECT p.*, list_transform((SELECT w FROM {w}), "
                                     f"lambda r: list_dot_product(r, p.x)) AS h FROM {before} p"))
            h = "h"
            if net.batch_norm:
                h = each("(h[k] - nm[k]) / sqrt(nv[k] + 1e-5) * ng[k] + nb[k]", half)
            also = ""
            if net.batch_norm and batch:
                h, also = h.replace("nm[k]", "bm[k]").replace("nv[k]", "bv[k]"), f", {at}_m"
                parts.append((f"{at}_m", f"""
SELECT list(m ORDER BY k) AS bm, list(v ORDER BY k) AS bv FROM (
  SELECT k, avg(h) AS m, var_pop(h) AS v FROM (
    SELECT unnest(h) AS h, unnest(range({half})) AS k FROM {at}_h) GROUP BY k)"""))
            parts.append((f"{at}_n", f"SELECT p.* EXCLUDE (h), {h} AS h FROM {at}_h p, {w}{also}"))
            norm = each(
                "(h[k] - list_avg(h)) / sqrt(list_var_pop(h) + 1e-5) * g[k] + o[k]", half
            ).replace("list_avg(h)", "m").replace("list_var_pop(h)", "s")
            parts.append((f"{at}_s", f"SELECT p.*, list_avg(h) AS m, list_var_pop(h) AS s "
                                     f"FROM {at}_n p"))
            parts.append((f"{at}_l", f"SELECT p.* EXCLUDE (m, s), {norm} AS n FROM {at}_s p, {w}"))
            value = "n" if net.normalise_cross else "h"
            if net.gated:
                value = each("h[k] / (1 + exp(-(list_dot_product(gw[k], h) + gb[k])))", half)
            parts.append((f"{at}_v", f"SELECT p.* EXCLUDE (h), {value} AS c FROM {at}_l p, {w}"))
            factor = "x" if branch == "deep" and net.chain_deep else "x0"
            cross = (f"CASE WHEN k <= {half} THEN c[k] WHEN k <= {2 * half} "
                     f"THEN c[k - {half}] * greatest(n[k - {half}], 0) ELSE 0 END")
            z = each(f"greatest(least({factor}[k] * ({cross} + b[k]) + x[k], {net.clip}), "
                     f"-{net.clip})", width)
            parts.append((f"{at}_z", f"SELECT p.*, {z} AS z FROM {at}_v p, {w}"))
            parts.append((f"{at}_r", f"SELECT p.*, sqrt(list_dot_product(z, z)) + 1e-12 AS r "
                                     f"FROM {at}_z p"))
            parts.append((at, f"SELECT {state}, list_transform(z, lambda e: e / r) AS x "
                              f"FROM {at}_r p"))
            before = at
            tensor += 10
        fc = rule(tensor, width, times=4.0)
        bias = f"({rule(tensor + 1, 1)})[1]"
        logits.append(f"{branch}_logit")
        kept_x = f", x AS {branch}_x" if last_x else ""
        parts.append((f"{branch}_out", f"SELECT {state}, list_dot_product(x, {fc}) + {bias} "
                                       f"AS {branch}_logit{kept_x} FROM {before}"))
        before = f"{branch}_out"
        if last_x:
            logits.append(f"{branch}_x")
        carried = f"{keep}, x0" + "".join(f", {n}" for n in logits)
        tensor += 10
    parts.append(("scored", f"""
SELECT {keep}, 1 / (1 + exp(-(deep_logit + shallow_logit) * 0.5)) AS score,
  1 / (1 + exp(-deep_logit)) AS score_deep, 1 / (1 + exp(-shallow_logit)) AS score_shallow
  {', deep_x, shallow_x' if last_x else ''}
FROM {before}"""))
    return tuple(parts)


def scored(domain: DomainConfig, form: str) -> str:
    width = sum(widths(domain))
    return ctes(*training(domain, form), *network(
        "matrix", domain.network, width, "username, content_id, profile_id, label"
    ))


# -- ranking -----------------------------------------------------------------------

def ranked(
    form: str, domain: DomainConfig = DOMAINS["movie"], ids: str = "true"
) -> tuple[tuple[str, str], ...]:
    """Every profile x every item (of which ``ids`` holds), scored; the best N with their place."""
    return (
        *tables(domain), LOG[form], *vectors(domain),
        ("profiles", """
SELECT DISTINCT l.username, l.profile_id FROM log l WHERE l.profile_id IS NOT NULL"""),
        ("pairs", """
SELECT p.profile_id, i.content_id, i.item_ord, list_concat(u.u, i.v) AS x
FROM profiles p JOIN user_x u ON p.username = u.username
CROSS JOIN (SELECT * FROM item_x WHERE """ + ids + """) i"""),
        *network("pairs", domain.network, sum(widths(domain)),
                 "profile_id, content_id, item_ord"),
        ("best", """
SELECT profile_id, content_id, max(round(score, 12)) AS score, min(item_ord) AS item_ord
FROM scored GROUP BY profile_id, content_id"""),
        ("ranked", f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY profile_id
                 ORDER BY score DESC, item_ord, content_id) AS rank FROM best)
WHERE rank <= {TOP_N}"""),
    )


RULE_VALUES = ", ".join(f"({o}, '{t}', {r})" for o, t, r in A.RULES)
TAG_LIST = ", ".join(f"'{w}'" for w in A.TAG_WORDS)
TAGS = (
    ("tags", f"""
SELECT DISTINCT list_position([{TAG_LIST}], word)::BIGINT AS tag_id, word AS tag_name
FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part)
WHERE word <> '{A.UNKNOWN_TAG}' AND list_contains([{TAG_LIST}], word)"""),
    ("rules", f"SELECT * FROM (VALUES {RULE_VALUES}) r(rule_ord, list_tags_id, rule_id)"),
)
META = ("meta", """
SELECT content_id, arg_min(content_name, item_ord) AS content_name,
  (list(tag_names ORDER BY item_ord))[1] AS tag_names, arg_min(type_id, item_ord) AS type_id
FROM catalogue GROUP BY content_id""")
ITEM_RULES = (
    ("item_tags", """
SELECT m.content_id, list(DISTINCT coalesce(CAST(t.tag_id AS VARCHAR), 'None')) AS tags
FROM (SELECT content_id, unnest(string_split(coalesce(tag_names, 'None'), ', ')) AS tag_name
      FROM meta) m LEFT JOIN tags t ON m.tag_name = t.tag_name
GROUP BY m.content_id"""),
    ("item_rules", """
SELECT i.content_id, coalesce((arg_min(r.rule_id, r.rule_ord)), -100)::BIGINT AS rule_id
FROM item_tags i LEFT JOIN rules r ON list_has_all(i.tags, string_split(r.list_tags_id, ','))
GROUP BY i.content_id"""),
)
SHOWN = ("shown", """
SELECT r.profile_id, u.username, r.rank, r.content_id, m.content_name,
  coalesce(m.tag_names, 'None') AS tag_names, m.type_id, r.score, g.rule_id
FROM ranked r JOIN meta m ON r.content_id = m.content_id
JOIN item_rules g ON r.content_id = g.content_id
JOIN (SELECT p.profile_id, min(p.username) AS username FROM profiles p
      JOIN clean_users c ON p.username = c.username GROUP BY p.profile_id) u
  ON r.profile_id = u.profile_id""")
GROUPED = ("grouped", """
SELECT profile_id, rule_id, min(rank) AS first_rank,
  string_agg('$' || type_id || '#' || content_id, '' ORDER BY rank) AS contents
FROM shown WHERE rule_id <> -100 GROUP BY profile_id, rule_id""")


def shown() -> str:
    return ctes(*ranked("dense"), *TAGS, META, *ITEM_RULES, SHOWN, GROUPED)


# -- the queries -------------------------------------------------------------------

def _clean_sql(domain: DomainConfig) -> str:
    rounding = " REPLACE (round(content_publish_year, 6) AS content_publish_year)" \
        if "content_publish_year" in domain.item_columns else ""
    columns = ", ".join(quoted(c) for c in domain.item_columns)
    return (
        ctes(CATALOGUE, TIMED, clean_items(domain))
        + f"SELECT *{rounding} FROM (SELECT {columns} FROM clean_items)"
    )


def _train_sql(domain: DomainConfig, form: str) -> str:
    scaled = [
        f"round({standardise(c, 'clean_items')}, 6) AS {c}" for c in domain.scaled
    ]
    return ctes(*tables(domain), LOG[form], labelled(domain)) + f"""
SELECT username, content_id, profile_id, sex, content_status, label,
  round({standardise('birthday', 'clean_users')}, 6) AS birthday,
  round({duration_of(domain)}, 6) AS content_duration{''.join(', ' + s for s in scaled)}
FROM labelled"""


def _watch_sql(form: str) -> str:
    return ctes(*tables(DOMAINS["movie"]), LOG[form], labelled(DOMAINS["movie"])) + """
SELECT username, content_id, profile_id, duration, watch_count, round(share, 6) AS share, label
FROM labelled"""


def _matrix_sql(domain: DomainConfig, form: str) -> str:
    return ctes(*training(domain, form)) + """
SELECT username, content_id, profile_id, label,
  len(list_filter(x, lambda e: e <> 0))::BIGINT AS entries,
  round(list_dot_product(x, list_transform(range(1, len(x) + 1), lambda k: k::DOUBLE)), 5)
    AS weighted
FROM matrix"""


def _score_sql(domain: DomainConfig, form: str) -> str:
    return scored(domain, form) + """
SELECT username, content_id, profile_id, label, round(score, 6) AS score,
  round(score_deep, 6) AS score_deep, round(score_shallow, 6) AS score_shallow FROM scored"""


def _vocab_sql() -> str:
    columns = [("package_code", "clean_users")] + [
        (c, "clean_items") for c in DOMAINS["movie"].one_hot
    ]
    parts = [
        f"SELECT DISTINCT 'one_hot' AS kind, '{c}' AS source, {c} AS value FROM {t}"
        for c, t in columns
    ]
    parts.append("""
SELECT DISTINCT 'multi_hot', 'content_cate_id',
  unnest(string_split(coalesce(content_cate_id, ''), ',')) FROM clean_items""")
    return ctes(*tables(DOMAINS["movie"]), ("v", " UNION ALL ".join(parts))) + """
SELECT kind, source, value,
  row_number() OVER (PARTITION BY kind, source ORDER BY value NULLS LAST) - 1 AS ordinal FROM v"""


def _stats_sql() -> str:
    parts = [
        f"SELECT '{c}' AS source, round(avg({c}), 6) AS mean, "
        f"round(CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END, 6) AS sd FROM {t}"
        for c, t in (("birthday", "clean_users"), ("content_publish_year", "clean_items"))
    ]
    return ctes(*tables(DOMAINS["movie"])) + " UNION ALL ".join(parts)


def _user_features_sql() -> str:
    hot = ", ".join(
        f"CAST(package_code = '{v}' AS INTEGER)::DOUBLE AS \"package_code_{v}\"" for v in PACKAGES
    )
    return ctes(USERS, CLEAN_USERS) + f"""
SELECT username, sex, {hot}, round({standardise('birthday', 'clean_users')}, 6) AS birthday
FROM clean_users"""


def _item_features_sql() -> str:
    domain = DOMAINS["movie"]
    values = {"content_country": COUNTRIES, "VOD_CODE": BRANDS, "type_id": TYPES}
    hot = [
        f"CAST({c} = '{v}' AS INTEGER)::DOUBLE AS \"{c}_{v}\""
        for c in domain.one_hot for v in values[c]
    ]
    multi = [
        f"CAST(list_contains(string_split(coalesce(content_cate_id, ''), ','), '{v}') "
        f"AS INTEGER) AS \"content_cate_id_{v}\"" for v in CATEGORIES
    ]
    return ctes(*tables(domain)) + f"""
SELECT content_id, content_single, content_duration, content_status, {', '.join(hot + multi)},
  round({standardise('content_publish_year', 'clean_items')}, 6) AS content_publish_year
FROM clean_items"""


def _diagnostics_sql() -> str:
    return ctes(*tables(DOMAINS["all"]), LOG["wide"], (
        "a", "SELECT l.* FROM log l JOIN clean_users u ON l.username = u.username"
    ), ("b", "SELECT a.*, i.* EXCLUDE (content_id, tag_names, item_ord) FROM a "
             "JOIN clean_items i ON a.content_id = i.content_id")) + """
SELECT (SELECT count(*) FROM log) AS log_rows,
  (SELECT count(DISTINCT content_id) FROM log) AS log_contents,
  (SELECT count(*) FROM clean_users) AS user_rows,
  (SELECT count(DISTINCT username) FROM clean_users) AS usernames,
  (SELECT count(*) FROM clean_items) AS item_rows,
  (SELECT count(DISTINCT content_id) FROM clean_items) AS contents,
  (SELECT count(*) FROM a) AS rows_after_users,
  (SELECT count(DISTINCT username) FROM a) AS usernames_after_users,
  (SELECT count(*) FROM b) AS rows_after_items,
  (SELECT count(DISTINCT content_id) FROM b) AS contents_after_items,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM b)) AS rows_after_distinct"""


def _split_sql(domain: DomainConfig) -> str:
    share = domain.validation_share
    return ctes(
        *tables(domain), LOG["wide"], labelled(domain),
        ("c", "SELECT label, count(*) AS n, sum(count(*)) OVER () AS t FROM labelled "
              "GROUP BY label"),
        ("e", f"SELECT *, ceil({share}::DOUBLE * t) AS w, "
              f"ceil({share}::DOUBLE * t) * n / t AS q FROM c"),
        ("f", "SELECT *, floor(q) AS base, "
              "row_number() OVER (ORDER BY q - floor(q) DESC, label) AS place, "
              "w - sum(floor(q)) OVER () AS spare FROM e"),
        ("g", "SELECT label, n::BIGINT AS n, "
              "(base + CASE WHEN place <= spare THEN 1 ELSE 0 END)::BIGINT AS v FROM f"),
    ) + """
SELECT 'validation' AS split, label, v AS n FROM g WHERE v > 0
UNION ALL SELECT 'train', label, n - v FROM g WHERE n > v"""


def _metric_sql(select: str) -> str:
    return scored(DOMAINS["movie"], "dense") + select


def _tri_bce_sql(weight: str) -> str:
    def mean(score: str) -> str:
        return (
            f"avg(({weight}) * -(label * greatest(ln({score}), -100) "
            f"+ (1 - label) * greatest(ln(1 - {score}), -100)))"
        )

    return _metric_sql(f"""
SELECT round(j, 6) AS loss_joint, round(d, 6) AS loss_deep, round(s, 6) AS loss_shallow,
  round(j + d * greatest(d - j, 0) + s * greatest(s - j, 0), 6) AS loss
FROM (SELECT {mean('score')} AS j, {mean('score_deep')} AS d, {mean('score_shallow')} AS s
      FROM scored,
        (SELECT sum(label)::DOUBLE AS pos, (count(*) - sum(label))::DOUBLE AS neg FROM matrix))""")


def _weighted_loss(score: str) -> str:
    return (
        f"avg(w * -(label * greatest(ln({score}), -100) "
        f"+ (1 - label) * greatest(ln(1 - {score}), -100)))"
    )


_CLASS_WEIGHT = "sqrt((count(*) - sum(label)) / sum(label)::DOUBLE)"
_WEIGHTED = (
    ("class_weight", f"SELECT {_CLASS_WEIGHT} AS pos_w FROM matrix"),
    ("weighted", """
SELECT *, CASE WHEN label = 1 THEN pos_w ELSE 1 END AS w FROM scored, class_weight"""),
    ("losses", f"""
SELECT count(*) AS n, {_weighted_loss('score')} AS j, {_weighted_loss('score_deep')} AS d,
  {_weighted_loss('score_shallow')} AS s,
  count(*) FILTER (score > 0.5 AND label = 1) AS tp,
  count(*) FILTER (score > 0.5 AND label = 0) AS fp,
  count(*) FILTER (score <= 0.5 AND label = 1) AS fn,
  count(*) FILTER (score <= 0.5 AND label = 0) AS tn FROM weighted"""),
)


def _gradient_sql(domain: DomainConfig) -> str:
    weight = _CLASS_WEIGHT if domain.weighted_loss else "max(1.0)"
    slope = "(CASE WHEN {0} > j THEN 2 * {0} - j ELSE 0 END)"
    base = "(1 - CASE WHEN d > j THEN d ELSE 0 END - CASE WHEN s > j THEN s ELSE 0 END)"

    def g(branch: str, own: str) -> str:
        return (
            f"w * ({base} * 0.5 * (score - label) + {slope.format(own)} "
            f"* (score_{branch} - label)) / n"
        )

    def output(branch: str) -> str:
        return f"""
SELECT '{branch}.fc_b', 0, sum(g_{branch}) FROM slopes UNION ALL
SELECT '{branch}.fc_w', k, sum(g * x) FROM (
  SELECT g_{branch} AS g, unnest({branch}_x) AS x,
    unnest(range(len({branch}_x))) AS k FROM slopes) GROUP BY k"""

    return ctes(
        *training(domain, "dense"),
        *network("matrix", domain.network, sum(widths(domain)),
                 "username, content_id, profile_id, label", last_x=True, batch=True),
        ("class_weight", f"SELECT {weight} AS pos_w FROM matrix"), *_WEIGHTED[1:],
        ("slopes", f"SELECT *, {g('deep', 'd')} AS g_deep, {g('shallow', 's')} AS g_shallow "
                   "FROM weighted, losses"),
        ("parts", """
SELECT 'loss' AS name, 0 AS position, j + d * greatest(d - j, 0) + s * greatest(s - j, 0) AS value
FROM losses
UNION ALL SELECT unnest(['n', 'tp', 'fp', 'fn', 'tn']), 0, unnest([n, tp, fp, fn, tn])::DOUBLE
FROM losses UNION ALL""" + output("deep") + " UNION ALL " + output("shallow")),
    ) + "SELECT name, position::BIGINT AS position, round(value, 6) AS value FROM parts"


VALIDATION_PASS = scored(DOMAINS["movie"], "dense").rstrip() + ",\n" + ",\n".join(
    f"{name} AS ({body})" for name, body in _WEIGHTED
) + """
SELECT round(j + d * greatest(d - j, 0) + s * greatest(s - j, 0), 6) AS loss,
  round((tp + tn) / n::DOUBLE, 6) AS accuracy,
  round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 6) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 6) AS f1,
  round((SELECT sum(p * (b + q / 2)) / (sum(p) * sum(q)) FROM (
    SELECT p, q, coalesce(sum(q) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
                                       AND 1 PRECEDING), 0) AS b
    FROM (SELECT score, sum(label)::DOUBLE AS p, sum(1 - label)::DOUBLE AS q
          FROM scored GROUP BY score))), 6) AS auc
FROM losses"""

COLUMNS = (
    "content_id, content_name, tag_names, type_id, content_duration, content_status, "
    '"VOD_CODE", content_cate_id, content_publish_year, content_country, content_single'
)
MANY_RULES = ("rules", f"""
SELECT p_partkey::INTEGER AS rule_ord, p_partkey + 1000 AS rule_id,
  array_to_string(list_transform(string_split(p_name, ' ')[1:2],
    lambda w: coalesce(list_position([{TAG_LIST}], w), 0)::VARCHAR), ',') AS list_tags_id
FROM part""")
RULE_MAP = ("rule_map", """
SELECT list_tags_id, min(rule_ord) AS rule_ord, arg_max(rule_id, rule_ord) AS rule_id
FROM rules GROUP BY list_tags_id""")


def _file_sql(shown_rows: dict[str, str]) -> dict[str, str]:
    """The queries through files, against the tables themselves."""
    return {
        "file_log": ctes(LOG["dense"]) + """
SELECT username, content_id, duration, profile_id FROM log WHERE profile_id % 3 <> 2""",
        "file_log_report": ctes(LOG["dense"]) + """
SELECT CASE profile_id % 3 WHEN 2 THEN 'missing duration' ELSE 'ok' END AS status,
  CASE profile_id % 3 WHEN 0 THEN 'string,string,double,bigint'
    WHEN 1 THEN 'string,bigint,double,bigint' ELSE '' END AS signature, count(*) AS n_rows
FROM log GROUP BY ALL""",
        "file_catalogue_grown": ctes(CATALOGUE) + """
SELECT 'first' AS step, true AS rebuilt, content_id FROM catalogue WHERE item_ord % 2 = 0
UNION ALL SELECT 'same', false, content_id FROM catalogue WHERE item_ord % 2 = 0
UNION ALL SELECT 'grown', true, content_id FROM catalogue""",
        "tag_map_stored": ctes(*TAGS) + "SELECT tag_name, tag_id FROM tags",
        "file_users": ctes(USERS) + "SELECT username, birthday, sex, package_code FROM users",
        "file_catalogue": ctes(CATALOGUE) + f"SELECT {COLUMNS} FROM catalogue",
        "file_tags": ctes(*TAGS) + "SELECT tag_name, tag_id FROM tags",
        "file_rules": ctes(MANY_RULES, RULE_MAP) + """
SELECT rule_ord - (SELECT min(rule_ord) FROM rules) AS rule_ord, list_tags_id, rule_id
FROM rule_map""",
        "file_merged_catalogue": ctes(CATALOGUE) + """
SELECT content_id, content_name, type_id, 0::BIGINT AS low,
  (SELECT count(*) - 1 FROM catalogue) AS high, (SELECT count(*) FROM catalogue) AS places
FROM catalogue""",
        "file_training_set": _matrix_sql(DOMAINS["movie"], "dense"),
        "file_vocab": _vocab_sql(),
        "content_meta_repeated": ctes(
            ("all_rows", SQL["catalogue"]),
            ("catalogue", "SELECT * REPLACE ((item_ord % 97)::VARCHAR AS content_id) "
                          "FROM all_rows"), META,
        ) + "SELECT * FROM meta",
        "tag_map_repeated": """
SELECT tag_name, max(tag_id) AS tag_id FROM (
  SELECT p_partkey AS tag_id, unnest(string_split(p_name, ' ')) AS tag_name FROM part)
GROUP BY tag_name""",
        "item_rules_many": ctes(
            CATALOGUE, TAGS[0], MANY_RULES, META, ITEM_RULES[0], RULE_MAP,
        ) + """
SELECT i.content_id, coalesce(arg_min(r.rule_id, r.rule_ord), -100)::BIGINT AS rule_id
FROM item_tags i LEFT JOIN rule_map r ON list_has_all(i.tags, string_split(r.list_tags_id, ','))
GROUP BY i.content_id""",
        "sink_results": shown_rows["result_documents"],
        "sink_rulename": shown_rows["rulename"],
        "sink_rule_content": shown_rows["rule_content"],
    }


def _checks_sql() -> dict[str, str]:
    """Fan-out, set columns, history, and what is stored and read again."""
    movie = DOMAINS["movie"]
    many = dict(tables(movie))
    many["clean_users"] = f"""
SELECT * FROM ({many['clean_users']})
UNION ALL SELECT * REPLACE ('again' AS package_code) FROM ({many['clean_users']})
WHERE birthday % 5 = 0"""
    many["clean_items"] = f"""
SELECT * FROM ({many['clean_items']})
UNION ALL SELECT * REPLACE (9 AS content_status) FROM ({many['clean_items']})
WHERE item_ord % 3 = 0"""
    width, tensors, tensor = sum(widths(movie)), [], 0
    half = width // 2
    for branch in ("deep", "shallow"):
        tensors += [(f"{branch}.0.w", tensor, half, width, 0, 1), (f"{branch}.0.b", tensor + 1, 1, width, 0, 1),
                    (f"{branch}.0.ln_g", tensor + 2, 1, half, 1, 1),
                    (f"{branch}.0.ln_b", tensor + 3, 1, half, 0, 1)]
        tensors += [(f"{branch}.fc_w", tensor + 10, 1, width, 0, 4),
                    (f"{branch}.fc_b", tensor + 11, 1, 1, 0, 1)]
        tensor += 20
    values = ", ".join(map(str, tensors))
    return {
        "watch_counts_repeated": ctes(*many.items(), LOG["dense"], labelled(movie)) + """
SELECT username, content_id, profile_id, duration, package_code,
  content_status::BIGINT AS content_status, watch_count, round(share, 6) AS share, label
FROM labelled""",
        "training_positions_movie": ctes(*training(movie, "wide")) + """
SELECT username, content_id, profile_id, label, md5(array_to_string(
  list_filter(range(len(x)), lambda k: x[k + 1] <> 0), ',')) AS positions FROM matrix""",
        "topn_resumed": ORACLE["topn_crossnet_grid"],
        "user_features_loaded": _user_features_sql(),
        "train_history": VALIDATION_PASS.replace("SELECT round(j + d", """, passed AS (
SELECT round(j + d""") + """)
SELECT round, epoch, loss AS train_loss, accuracy AS train_accuracy,
  precision AS train_precision, recall AS train_recall, f1 AS train_f1, loss AS val_loss,
  accuracy, precision, recall, f1, auc
FROM passed, (VALUES (1, 1), (1, 2), (2, 1), (2, 2)) h(round, epoch)""",
        "model_stored": f"""
WITH tensors AS (
  SELECT * FROM (VALUES {values}) t(name, tensor, n_rows, n_cols, plus, times)
  WHERE EXISTS (SELECT 1 FROM part)
), numbers AS (
  SELECT name, j * n_cols + i + 1 AS place,
    plus + times * ((((7 * i + 13 * j + 5 * tensor) % 31) - 15) / 32.0::DOUBLE) AS value
  FROM (SELECT *, unnest(range(n_cols)) AS i FROM (SELECT *, unnest(range(n_rows)) AS j FROM tensors))
), sums AS (
  SELECT name, sum(value) AS total, sum(value * place) AS weighted FROM numbers GROUP BY name
)
SELECT 'weight' AS kind, name, round(total, 6) AS total, round(weighted, 6) AS weighted,
  4::BIGINT AS step, 2::BIGINT AS epoch FROM sums
UNION ALL SELECT 'first', name, round(0.2 * total, 6), round(0.2 * weighted, 6), 4, 2 FROM sums""",
    }


LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]

ORACLE: dict[str, str] = {
    "log_slices": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
  CASE WHEN t < 5 THEN 4 ELSE least(4, (p // greatest(t // 5, 1)))::BIGINT END AS slice
FROM (SELECT *, row_number() OVER (ORDER BY {', '.join(LINE)}) - 1 AS p, count(*) OVER () AS t
      FROM lineitem)""",
    "log_file_slices": """
SELECT event_id, user_id, value, p AS position,
  CASE WHEN t < 5 THEN 4 ELSE least(4, (p // greatest(t // 5, 1)))::BIGINT END AS slice
FROM (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS p, count(*) OVER () AS t
      FROM events)""",
    "user_clean": ctes(USERS, CLEAN_USERS) + "SELECT * FROM clean_users",
    "user_head": ctes(USERS, CLEAN_USERS) + "SELECT * FROM clean_users ORDER BY username LIMIT 100",
    **{f"item_clean_{n}": _clean_sql(c) for n, c in DOMAINS.items()},
    "item_filtered_head": ctes(CATALOGUE, TIMED) + r"""
SELECT item_ord, content_id, tag_names, content_duration FROM timed
WHERE content_status = '1' AND regexp_matches(tag_names, '[\p{L}\p{N}_]')
ORDER BY item_ord LIMIT 100""",
    "user_features": _user_features_sql(),
    "item_features_wide": _item_features_sql(),
    "feature_vocab": _vocab_sql(),
    "feature_stats": _stats_sql(),
    **{f"train_{n}": _train_sql(c, "wide") for n, c in DOMAINS.items()},
    **{f"train_{n}_dense": _train_sql(c, "dense") for n, c in DOMAINS.items()},
    "watch_counts": _watch_sql("wide"),
    "watch_counts_dense": _watch_sql("dense"),
    "training_matrix_movie": _matrix_sql(DOMAINS["movie"], "wide"),
    **{f"training_matrix_{n}": _matrix_sql(DOMAINS[n], "wide") for n in ("clip", "music")},
    "training_matrix_all_dense": _matrix_sql(DOMAINS["all"], "dense"),
    "join_diagnostics": _diagnostics_sql(),
    "join_estimates": ctes(*tables(DOMAINS["all"]), LOG["wide"]) + """
SELECT (SELECT count(*) FROM log) AS log_rows,
  (SELECT count(DISTINCT username) FROM log) AS log_usernames,
  (SELECT count(DISTINCT content_id) FROM log) AS log_contents,
  (SELECT count(DISTINCT username) FROM clean_users) AS usernames,
  (SELECT count(DISTINCT content_id) FROM clean_items) AS contents,
  (SELECT count(DISTINCT username) FROM log JOIN clean_users USING (username))
    AS shared_usernames,
  (SELECT count(DISTINCT content_id) FROM log JOIN clean_items USING (content_id))
    AS shared_contents""",
    "content_overlap": ctes(*tables(DOMAINS["all"]), LOG["wide"]) + """
SELECT content_id FROM log INTERSECT SELECT content_id FROM clean_items""",
    "class_distribution": ctes(*tables(DOMAINS["movie"]), LOG["wide"],
                               labelled(DOMAINS["movie"])) + """
SELECT label, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent
FROM labelled GROUP BY label""",
    "pos_weight": ctes(*tables(DOMAINS["movie"]), LOG["wide"], labelled(DOMAINS["movie"])) + """
SELECT round(sqrt((count(*) - sum(label)) / sum(label)::DOUBLE), 6) AS pos_weight FROM labelled""",
    "split_counts": _split_sql(DOMAINS["movie"]),
    "split_counts_all": _split_sql(DOMAINS["all"]),
    "profiles": ctes(USERS, CLEAN_USERS, LOG["wide"]) + """
SELECT u.username, p.profile_id, u.birthday, u.sex, u.package_code
FROM (SELECT DISTINCT username, profile_id FROM log WHERE profile_id IS NOT NULL) p
JOIN clean_users u ON p.username = u.username""",
    "content_meta": ctes(CATALOGUE, META) + "SELECT * FROM meta",
    "tag_map": ctes(*TAGS) + "SELECT tag_name, tag_id FROM tags",
    "rule_map": ctes(*TAGS) + """
SELECT rule_ord, list_tags_id, rule_id::BIGINT AS rule_id FROM rules r
WHERE NOT EXISTS (SELECT 1 FROM (SELECT unnest(string_split(r.list_tags_id, ',')) AS t)
                  WHERE t <> 'None' AND t NOT IN (SELECT tag_id::VARCHAR FROM tags))""",
    "item_rules": ctes(CATALOGUE, *TAGS, META, *ITEM_RULES) + "SELECT * FROM item_rules",
    "item_rules_division": ctes(CATALOGUE, *TAGS, META, *ITEM_RULES) + "SELECT * FROM item_rules",
    "score_crossnet": _score_sql(DOMAINS["movie"], "wide"),
    "score_crossnet_clip": _score_sql(DOMAINS["clip"], "dense"),
    "score_crossnet_music": _score_sql(DOMAINS["music"], "dense"),
    "score_crossnet_all": _score_sql(DOMAINS["all"], "dense"),
    "confusion_metrics": _metric_sql("""
SELECT tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn)::DOUBLE, 6) AS accuracy,
  round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 6) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 6) AS f1
FROM (SELECT count(*) FILTER (score > 0.5 AND label = 1) AS tp,
             count(*) FILTER (score > 0.5 AND label = 0) AS fp,
             count(*) FILTER (score <= 0.5 AND label = 1) AS fn,
             count(*) FILTER (score <= 0.5 AND label = 0) AS tn FROM scored)"""),
    "roc_auc": _metric_sql("""
SELECT round(sum(p * (b + n / 2)) / (sum(p) * sum(n)), 6) AS auc FROM (
  SELECT p, n, coalesce(sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
                                     AND 1 PRECEDING), 0) AS b
  FROM (SELECT score, sum(label)::DOUBLE AS p, sum(1 - label)::DOUBLE AS n
        FROM scored GROUP BY score))"""),
    "tri_bce": _tri_bce_sql("1"),
    "tri_bce_weighted": _tri_bce_sql("CASE WHEN label = 1 THEN sqrt(neg / pos) ELSE 1 END"),
    "tri_bce_balanced": _tri_bce_sql(
        "CASE WHEN label = 1 THEN neg / (pos + neg) ELSE pos / (pos + neg) END"
    ),
    "topn_crossnet": ctes(*ranked("wide")) + """
SELECT profile_id, rank, content_id, round(score, 7) AS score FROM ranked""",
    "topn_crossnet_grid": ctes(*ranked("dense")) + """
SELECT profile_id, rank, content_id, round(score, 7) AS score FROM ranked""",
    "topn_meta": shown() + """
SELECT profile_id, username, rank, content_id, content_name, tag_names, type_id,
  round(score, 7) AS score, rule_id FROM shown""",
    "result_documents": shown() + """
SELECT profile_id, username, content_id, content_name, tag_names, type_id,
  round(score, 7) AS score, rule_id FROM shown""",
    "topn_null_ids": ctes(
        *ranked("dense", ids="item_ord % 43 <> 0"), *TAGS, META, *ITEM_RULES, SHOWN
    ) + """
SELECT profile_id, rank, content_id, round(score, 7) AS score, rule_id FROM shown""",
    **{f"topn_crossnet_{n}": ctes(*ranked("dense", DOMAINS[n])) + """
SELECT profile_id, rank, content_id, round(score, 7) AS score FROM ranked"""
       for n in ("clip", "music", "all")},
    "gradient_pass": _gradient_sql(DOMAINS["movie"]),
    "gradient_pass_all": _gradient_sql(DOMAINS["all"]),
    "validation_pass": VALIDATION_PASS,
    "rulename": shown() + """
SELECT p.profile_id AS pid, coalesce(string_agg(g.rule_id::VARCHAR, ',' ORDER BY first_rank), '')
  AS d
FROM (SELECT DISTINCT profile_id FROM ranked) p LEFT JOIN grouped g
  ON p.profile_id = g.profile_id GROUP BY p.profile_id""",
    "rule_content": shown() + """
SELECT p.profile_id AS pid, p.profile_id::VARCHAR || '|' ||
  coalesce(string_agg(g.rule_id::VARCHAR || contents, ';' ORDER BY first_rank), '') AS line
FROM (SELECT DISTINCT profile_id FROM ranked) p LEFT JOIN grouped g
  ON p.profile_id = g.profile_id GROUP BY p.profile_id""",
}
ORACLE |= _file_sql(ORACLE)
ORACLE |= _checks_sql()
ORACLE["scoring_counts"] = ctes(
    *tables(DOMAINS["movie"]), LOG["dense"],
    ("p", "SELECT count(*) AS n FROM (SELECT DISTINCT username, profile_id FROM log "
          "WHERE profile_id IS NOT NULL) JOIN clean_users USING (username)"),
    ("i", "SELECT count(*) AS n FROM clean_items WHERE item_ord % 43 <> 0"),
) + """
SELECT p.n AS profile_rows, i.n AS items, p.n * i.n AS scored_pairs,
  (SELECT count(*) FILTER (profile_id IS NULL) FROM log) AS null_profiles,
  (SELECT count(*) FROM catalogue WHERE item_ord % 43 = 0) AS null_items,
  (SELECT string_agg(content_id, ',' ORDER BY content_id) FROM (
     SELECT DISTINCT content_id FROM clean_items WHERE item_ord % 43 <> 0
     ORDER BY content_id LIMIT 5)) AS sample
FROM p, i"""
