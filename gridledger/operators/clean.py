"""Column cleaning: renames, alignment, defaults, de-duplication, predicates."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridledger.functions.text import slugify


def header_name(name):
    """Lower case, ``%`` spelled out, spaces to underscores, plus signs dropped."""
    return name.lower().replace("%", "_pct").replace(" ", "_").replace("+", "")


def _rename_by_position(df, names):
    """Give columns new names and keep the first of each repeated name.

    The frame gets unique positional names first, so a repeated name never has
    to be resolved.
    """
    first = {}
    for position, name in enumerate(names):
        first.setdefault(name, position)
    held = df.toDF(*[f"c{i}" for i in range(len(names))])
    return held.select([F.col(f"c{i}").alias(name) for name, i in first.items()])


def dedupe_columns(df):
    """Drop repeated column names, keeping the first."""
    return _rename_by_position(df, df.columns)


def normalize_columns(df):
    return _rename_by_position(df, [header_name(c) for c in df.columns])


def snake_columns(df):
    """Only lower case and underscores."""
    return _rename_by_position(df, [c.lower().replace(" ", "_") for c in df.columns])


def rename_present(df, renames):
    """Apply the renames; where two columns end up with one name the first stays."""
    return _rename_by_position(df, [renames.get(c, c) for c in df.columns])


def normalize(df, aliases, season, week, key="pfr_player_id"):
    """Weekly box score to canonical columns, rows without an id dropped."""
    names = [header_name(aliases.get(c, c)) for c in df.columns]
    return with_meta(drop_null_key(_rename_by_position(df, names), key), season=season, week=week)


def slug_ids(df, name="Player", out="player_id"):
    """Add a slug of the player's name as id, then snake-case the headers."""
    if name in df.columns:
        df = df.withColumn(out, slugify(F.col(name)))
    return snake_columns(df)


def drop_null_key(df, key):
    return df.filter(F.col(key).isNotNull()) if key in df.columns else df


def not_null(df, columns):
    return df.dropna(subset=columns)


def with_meta(df, **values):
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def align(df, schema, default=0, fill=True):
    """Exactly the schema's columns, typed and in its order.

    Absent numeric columns become ``default`` and, with ``fill``, so do missing
    numbers; text stays NULL where missing. Other columns are dropped.
    """
    out = []
    for field in schema.fields:
        numeric = field.dataType.typeName() in ("integer", "long", "double")
        blank = F.lit(default if numeric else None).cast(field.dataType)
        if field.name not in df.columns:
            value = blank
        else:
            value = F.col(field.name).cast(field.dataType)
            if fill and numeric:
                value = F.coalesce(value, blank)
        out.append(value.alias(field.name))
    return df.select(out)


def fill_zero(df, columns):
    return df.fillna(0, subset=columns)


def fill_na_text(df, columns, value="N/A"):
    """Exactly these columns as text, absent or missing ones as ``N/A``."""
    return df.select(
        [
            F.coalesce(F.col(c).cast("string"), F.lit(value)).alias(c)
            if c in df.columns
            else F.lit(value).alias(c)
            for c in columns
        ]
    )


def dedupe(df, key, order_by):
    """First row per key in the given order.

    An aggregate instead of a row_number window: rows of a hot key are reduced
    before the shuffle.
    """
    key = [key] if isinstance(key, str) else list(key)
    order = F.struct(*order_by)
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*key).agg(F.min_by(row, order).alias("kept")).select("kept.*")


def coalesce_cols(df, out, columns):
    """First non-null of several columns, which are then dropped."""
    value = F.coalesce(*[F.col(c) for c in columns])
    kept = [F.col(c) for c in df.columns if c not in columns and c != out]
    return df.select(*kept, value.alias(out))


def with_default(df, column, value):
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))


def drop_empty_lines(df, points="fantasy_points"):
    return df.filter(F.col(points) != 0)


def has_activity(df, columns):
    """Rows in which any of the cells is not "0"; a missing cell counts as "0"."""
    cells = [
        F.coalesce(F.col(c), F.lit("0")) if c in df.columns else F.lit("0") for c in columns
    ]
    return df.filter(reduce(lambda a, b: a | b, [cell != "0" for cell in cells]))


def where(df, season=None, week=None, position=None, ids=None, key="gsis_id"):
    """Season / week / position / id-list predicates, all optional."""
    for column, value in (("season", season), ("week", week), ("position", position)):
        if value is not None:
            values = value if isinstance(value, (list, tuple)) else [value]
            df = df.filter(F.col(column).isin(*values))
    if ids is not None:
        df = df.filter(F.col(key).isin(*ids))
    return df


def project_present(df, columns):
    """The known columns the frame has, in the known order."""
    return df.select([c for c in columns if c in df.columns])


def union_seasons(frames):
    """Union by name; a column absent from some season is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_rank(df, order, out="rank"):
    """Running number in the given order; for frames bounded by a limit only."""
    return df.withColumn(out, F.row_number().over(Window.orderBy(*order)))


def pick_column(mapping, key, default=None):
    """The mapped column for a request word, else the default."""
    return mapping.get(key, default)
