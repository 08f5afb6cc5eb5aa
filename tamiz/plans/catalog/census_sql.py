"""SQL counterpart of the narrative census parser and its cleaning."""

from __future__ import annotations

from . import raw  # noqa: F401 - defines raw_census
from .base import CTES, survivor

CTES["census_clean"] = """
SELECT * FROM (
  SELECT list_filter(list_transform(cells, lambda x: trim(x)),
                     lambda x: x IS NOT NULL AND x <> '' AND x <> 'nan') AS a
  FROM raw_census) WHERE len(a) > 0
"""
CTES["census_1"] = r"""
SELECT a[1] AS cod_dpa,
       upper(trim(regexp_replace(a[2], 'PROVINCIA\s+(DE(L?|LA)?\s+)?', '', 'gi'))) AS nombre_provincia
FROM census_clean
WHERE len(a) = 2 AND regexp_matches(a[1], '^\d{2}$') AND upper(a[2]) LIKE '%PROVINCIA%'
"""
CTES["census_2"] = r"""
SELECT a[1] AS cod_provincia_dpa, a[1] || a[2] AS cod_canton,
       trim(ltrim(upper(trim(replace(a[3], 'CANTÓN ', ''))), '*')) AS nombre_canton
FROM census_clean
WHERE len(a) = 3 AND regexp_matches(a[1], '^\d{2}$') AND regexp_matches(a[2], '^\d{2}$')
  AND upper(a[3]) LIKE '%CANTÓN%'
"""
CTES["census_3"] = r"""
SELECT cp AS cod_provincia_dpa, cp || cc AS cod_canton,
       cp || cc || CASE WHEN length(leaf) < 2 THEN '0' || leaf ELSE leaf END AS cod_parroquia,
       upper(trim(ltrim(nm, '*'))) AS nombre_parroquia
FROM (SELECT a[i] AS cp, a[i + 1] AS cc, a[i + 2] AS leaf, a[i + 3] AS nm
      FROM (SELECT a, unnest(generate_series(1, len(a) - 3, 4)) AS i
            FROM census_clean WHERE len(a) >= 4))
WHERE regexp_matches(cp, '^\d{2}$') AND regexp_matches(cc, '^\d{2}$')
  AND regexp_matches(leaf, '^\d{1,2}$') AND length(nm) > 2 AND upper(nm) NOT LIKE '%COMPRENDE%'
"""
CENSUS_COLUMNS = {
    "dpa_provincias": ("census_1", "cod_dpa", "nombre_provincia", []),
    "dpa_cantones": ("census_2", "cod_canton", "nombre_canton", ["cod_provincia_dpa"]),
    "dpa_parroquias": (
        "census_3", "cod_parroquia", "nombre_parroquia", ["cod_provincia_dpa", "cod_canton"],
    ),
}
for _t, (_source, _key, _name, _parents) in CENSUS_COLUMNS.items():
    _text = (
        f"trim(upper({_name}))" if _t == "dpa_provincias"
        else f"trim(regexp_replace(upper({_name}), '^\\*\\*?', ''))"
    )
    CTES[f"c_{_t}"] = survivor(
        f"SELECT {', '.join([*_parents, _key])}, {_text} AS {_name} FROM {_source}",
        [_key], [*_parents, _key, _name],
    )
