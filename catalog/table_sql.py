"""Checks of the table cohort: every stay against every row of its pools, as the definitions read."""

from __future__ import annotations

from casemill.standins import with_views
from catalog.table_queries import SHARES
from catalog.sql import below, between, bits, generation_id, laid_out, spread, u

ORDER = ["GHM5", "DP", "AGE", "SEXE"]
INPUTS = ["pmsi_dp", "pmsi_das", "pmsi_ccam", "pmsi_dms", "rghm", "cim10", "ccam_ref"]

STAYS = [
    (
        "profiles",
        "SELECT GHM5, DP, AGE, SEXE, CAST(sum(P_DP) AS BIGINT) AS w FROM pmsi_dp"
        " WHERE GHM5 IS NOT NULL AND DP IS NOT NULL GROUP BY 1, 2, 3, 4",
    ),
    ("laid", laid_out("profiles", [], [spread(*ORDER, digits=3), *ORDER])),
    ("asked", f"SELECT o_orderkey AS stay_id, {below(bits('profile', 'o_orderkey'), '(SELECT max(total) FROM laid)')} AS t FROM orders"),
    ("stays", "SELECT stay_id, GHM5, DP, AGE, SEXE FROM asked ASOF JOIN laid ON asked.t >= laid.lo"),
]

def fractional() -> str:
    """Each weight floored on a line of 61 bits: one line for all parts, and one for those of each scale."""
    shares = "[" + ", ".join(f"CAST({x!r} AS DOUBLE)" for x in SHARES) + "]"
    parts = f"SELECT p_partkey AS item, p_partkey % 10 AS scale, CAST(p_retailprice AS DOUBLE) * {shares}[p_partkey % 10 + 1] AS p FROM part"
    bins = "SELECT {0} AS line, CAST(floor(log2(p)) AS INT) AS e, count(*) AS n FROM parts GROUP BY ALL"
    rows = "SELECT {0} AS line, item, greatest(CAST(floor(p * s) AS BIGINT), 1) AS w FROM parts JOIN {1}_scale ON line = {0}"
    out = []
    for name, line, orders_line, digits in (("every", "0", "0", 3), ("scale", "scale", "o_orderkey % 10", 2)):
        out += [
            (f"{name}_bins", bins.format(line)),
            (f"{name}_scale", f"SELECT line, pow(CAST(2 AS DOUBLE), 61 - ceil(log2(sum(n * pow(CAST(2 AS DOUBLE), e + 1))))) AS s FROM {name}_bins GROUP BY 1"),
            (f"{name}_w", rows.format(line, name)),
            (f"{name}_laid", laid_out(f"{name}_w", ["line"], [spread("item", digits=digits), "item"])),
            (f"{name}_totals", f"SELECT line, max(total) AS total FROM {name}_laid GROUP BY 1"),
            (f"{name}_at", f"SELECT o_orderkey AS stay_id, line, {below(bits(name, 'o_orderkey'), 'total')} AS t FROM orders LEFT JOIN {name}_totals ON line = {orders_line}"),
            (name, f"SELECT stay_id, item FROM {name}_at a ASOF LEFT JOIN {name}_laid l ON a.line = l.line AND a.t >= l.lo"),
        ]
    ctes = ", ".join(f"{name} AS ({body})" for name, body in [("parts", parts), *out])
    return f"WITH {ctes} SELECT stay_id, e.item AS every_item, s.item AS scale_item FROM every e JOIN scale s USING (stay_id)"


CODE_LABELS = [
    ("dp_labels", "SELECT code, max(liblong) AS label FROM cim10 WHERE en_cours = 1 GROUP BY code"),
    ("ccam_labels", "SELECT code, max(liblong) AS label FROM ccam_ref WHERE en_cours = 1 GROUP BY code"),
    (
        "ghm_labels",
        "SELECT code, max(lib) AS label FROM rghm WHERE champ = 'mco' AND version = 'v2024' AND type_code = 'racine' GROUP BY code",
    ),
]


def shown(label: str, code: str) -> str:
    return f"CASE WHEN coalesce({label}, '') <> '' THEN {label} || ' (' || {code} || ')' ELSE {code} END"


def procedures(n_ccam: int = 3) -> list[tuple[str, str]]:
    levels = [("GHM5, DP", "b.DP = s.DP"), ("GHM5, substr(DP, 1, 3)", "substr(b.DP, 1, 3) = substr(s.DP, 1, 3)"), ("GHM5", "TRUE")]
    found = " UNION ALL ".join(
        f"SELECT s.GHM5, s.DP, {n} AS lvl, b.CCAM, sum(b.P_CCAM) AS w FROM (SELECT DISTINCT GHM5, DP FROM stays"
        f" WHERE GHM5 LIKE '%C%' OR GHM5 LIKE '%K%') s JOIN pmsi_ccam b ON b.GHM5 = s.GHM5 AND {match} GROUP BY 1, 2, 3, 4"
        for n, (_, match) in enumerate(levels, start=1)
    )
    key = f"-ln({u('ccam', 'stay_id', 'CCAM')}) / w"
    return [
        ("proc_found", found),
        ("proc_level", "SELECT GHM5, DP, min(lvl) AS lvl FROM proc_found WHERE w > 0 GROUP BY 1, 2"),
        (
            "proc_top",
            "SELECT * FROM (SELECT f.*, row_number() OVER (PARTITION BY f.GHM5, f.DP ORDER BY w DESC, CCAM) AS rank"
            " FROM proc_found f JOIN proc_level USING (GHM5, DP, lvl)) WHERE rank <= 5",
        ),
        (
            "proc_ranked",
            f"SELECT stay_id, CCAM, row_number() OVER (PARTITION BY stay_id ORDER BY {key}, CCAM) AS pos"
            " FROM stays JOIN proc_top USING (GHM5, DP)",
        ),
        (
            "proc_drawn",
            f"SELECT stay_id, string_agg({shown('label', 'CCAM')}, ', ' ORDER BY pos) AS ccam FROM proc_ranked"
            f" LEFT JOIN ccam_labels ON code = CCAM WHERE pos <= {between(u('ccam_count', 'stay_id'), 1, n_ccam)} GROUP BY 1",
        ),
    ]


def associated(n_das: int = 3) -> list[tuple[str, str]]:
    matches = [
        "p.AGE = s.AGE AND p.SEXE = s.SEXE AND p.DP = s.DP",
        "p.SEXE = s.SEXE AND p.DP = s.DP",
        "p.DP = s.DP",
        "substr(p.DP, 1, 3) = substr(s.DP, 1, 3)",
        "TRUE",
    ]
    pools = " UNION ALL ".join(
        f"SELECT s.stay_id, {n} AS lvl, p.DAS, substr(p.DAS, 1, 2) AS cat, CAST(sum(p.P_DAS) AS BIGINT) AS w"
        f" FROM wanting s JOIN pmsi_das p ON p.GHM5 = s.GHM5 AND {match} GROUP BY 1, 2, 3, 4"
        for n, match in enumerate(matches, start=1)
    )
    ctes = [
        ("wanting", f"SELECT *, {between(u('das_count', 'stay_id'), 0, n_das)} AS n FROM stays"),
        ("das_pool", pools),
    ]
    taken = "SELECT NULL AS stay_id, NULL AS cat WHERE FALSE"
    for j in range(1, n_das + 1):
        ctes += [
            (
                f"das_left_{j}",
                f"SELECT c.* FROM das_pool c JOIN wanting USING (stay_id) LEFT JOIN ({taken}) x ON x.stay_id = c.stay_id"
                f" AND x.cat = c.cat WHERE n >= {j} AND x.cat IS NULL",
            ),
            (
                f"das_at_{j}",
                f"SELECT l.* FROM das_left_{j} l JOIN (SELECT stay_id, min(lvl) AS lvl FROM das_left_{j} GROUP BY 1)"
                " USING (stay_id, lvl)",
            ),
            (f"das_laid_{j}", laid_out(f"das_at_{j}", ["stay_id"], ["cat", "DAS"])),
            (
                f"das_pick_{j}",
                f"SELECT stay_id, {j} AS pos, lvl, DAS, cat FROM (SELECT *, {below(bits(f'das_{j}', 'stay_id'), 'total')} AS t"
                f" FROM das_laid_{j}) WHERE t >= lo AND t < lo + w",
            ),
        ]
        taken = " UNION ALL ".join(f"SELECT stay_id, cat FROM das_pick_{i}" for i in range(1, j + 1))
    every = " UNION ALL ".join(f"SELECT * FROM das_pick_{j}" for j in range(1, n_das + 1))
    ctes.append(
        (
            "das_drawn",
            f"SELECT stay_id, string_agg({shown('label', 'DAS')}, ', ' ORDER BY pos) AS das, string_agg(DAS, ',' ORDER BY pos)"
            f" AS das_codes FROM ({every}) LEFT JOIN dp_labels ON code = DAS GROUP BY 1",
        )
    )
    return ctes


def days() -> list[tuple[str, str]]:
    drawn = u("dms", "stay_id")
    return [
        (
            "shape",
            "SELECT GHM5, lft, rgt, greatest(lft, least(DMS_P50, rgt)) AS mode FROM (SELECT GHM5, DMS_P25 AS lft, DMS_P50,"
            " CASE WHEN DMS_P25 = DMS_P75 THEN DMS_P25 + 1 ELSE DMS_P75 END AS rgt FROM pmsi_dms)",
        ),
        (
            "stay_days",
            f"SELECT stay_id, CASE WHEN lft IS NULL THEN 1 ELSE CAST(greatest(0, round_even(CASE WHEN {drawn} < (mode - lft) / (rgt - lft)"
            f" THEN lft + sqrt({drawn} * (rgt - lft) * (mode - lft)) ELSE rgt - sqrt((1 - {drawn}) * (rgt - lft) * (rgt - mode)) END, 0))"
            " AS INT) END AS dms FROM stays LEFT JOIN shape USING (GHM5)",
        ),
    ]


COHORT = [
    *STAYS,
    *CODE_LABELS,
    *procedures(),
    *associated(),
    *days(),
    (
        "cohort",
        f"SELECT s.stay_id, {generation_id('s.stay_id')} AS generation_id, AGE AS age, SEXE AS sexe, coalesce(g.label, GHM5) AS ghm5,"
        " GHM5 AS ghm5_code, coalesce(d.label, DP) AS dp, DP AS dp_code, coalesce(ccam, '') AS ccam, coalesce(das, '') AS das, dms"
        " FROM stays s LEFT JOIN ghm_labels g ON g.code = GHM5 LEFT JOIN dp_labels d ON d.code = DP"
        " LEFT JOIN proc_drawn p ON p.stay_id = s.stay_id LEFT JOIN das_drawn a ON a.stay_id = s.stay_id"
        " JOIN stay_days y ON y.stay_id = s.stay_id",
    ),
    (
        "texts",
        "SELECT *, 'Patient : ' || sexe || ', ' || age || '.' || chr(10) || 'GHM : ' || ghm5 || ' (' || ghm5_code || ').' || chr(10)"
        " || 'Diagnostic principal : ' || dp || ' (' || dp_code || ').' || chr(10) || 'Actes CCAM : '"
        " || CASE WHEN ccam = '' THEN 'Aucun' ELSE ccam END || '.' || chr(10) || 'Diagnostics associés : '"
        " || CASE WHEN das = '' THEN 'Aucun' ELSE das END || '.' || chr(10) || 'Durée de séjour : ' || dms || ' jours.' AS scenario FROM cohort",
    ),
]


def table_checks() -> dict[str, str]:
    return {
        "draw_weighted_with_replacement": with_views(["pmsi_dp"], *STAYS, final="SELECT * FROM stays"),
        "draw_weighted_fractional": fractional(),
        "draw_by_splitting": with_views(
            ["pmsi_dp"],
            final="SELECT GHM5 AS ghm5, CAST(sum(P_DP) AS BIGINT) AS w, (SELECT count(*) FROM orders) AS n_stays, TRUE AS near FROM pmsi_dp"
            " WHERE DP IS NOT NULL AND GHM5 IS NOT NULL GROUP BY 1 HAVING sum(P_DP) > 0",
        ),
        "draw_per_group": with_views(
            ["pmsi_dp"],
            *STAYS,
            ("in_group", "SELECT GHM5, DP, CAST(sum(P_DP) AS BIGINT) AS w FROM pmsi_dp WHERE GHM5 IS NOT NULL AND DP IS NOT NULL GROUP BY 1, 2"),
            ("group_laid", laid_out("in_group", ["GHM5"], [spread("DP"), "DP"])),
            ("wanting", "SELECT stay_id, CASE WHEN stay_id % 7 <> 0 THEN GHM5 END AS GHM5 FROM stays"),
            ("pools", f"SELECT stay_id, GHM5, {below(bits('in_group', 'stay_id'), 'total')} AS t FROM wanting JOIN (SELECT DISTINCT GHM5, total FROM group_laid) USING (GHM5)"),
            final="SELECT w.stay_id, w.GHM5 AS ghm5, l.DP AS dp FROM wanting w LEFT JOIN pools p USING (stay_id)"
            " LEFT JOIN group_laid l ON l.GHM5 = p.GHM5 AND p.t >= l.lo AND p.t < l.lo + l.w",
        ),
        "draw_procedures": with_views(
            INPUTS, *STAYS, *CODE_LABELS, *procedures(), final="SELECT s.stay_id, coalesce(ccam, '') AS ccam FROM stays s LEFT JOIN proc_drawn USING (stay_id)"
        ),
        "draw_associated_diagnoses": with_views(
            INPUTS,
            *STAYS,
            *CODE_LABELS,
            *associated(),
            final="SELECT s.stay_id, coalesce(das, '') AS das, coalesce(das_codes, '') AS das_codes FROM stays s LEFT JOIN das_drawn USING (stay_id)",
        ),
        "draw_triangular_days": with_views(INPUTS, *STAYS, *days(), final="SELECT stay_id, dms FROM stay_days"),
        "table_cohort": with_views(INPUTS, *COHORT, final="SELECT * FROM cohort"),
        "short_scenario_text": with_views(INPUTS, *COHORT, final="SELECT generation_id, scenario FROM texts"),
    }
