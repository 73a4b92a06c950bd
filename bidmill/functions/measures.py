"""Exact price sums and the mergeable partial measures kept by every stored table.

All measures are SQL expressions.
"""

from pyspark.sql import types as T

from bidmill.schema import PRICES

# Sums of doubles depend on row order, so doubles are summed as decimals of this type. What it
# cannot hold (digits beyond its scale, values beyond its range) is summed beside it, as doubles.
EXACT_TYPE = "decimal(28,10)"


def exact(column: str, data_type: T.DataType) -> str:
    """A number as something that sums exactly: floats become decimals, NULL where too large."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return f"try_cast({column} AS {EXACT_TYPE})"
    return column


def remainder(column: str, data_type: T.DataType) -> str:
    """What ``exact`` leaves of a number, as a double: 0 for all usual prices."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return f"{column} - coalesce(cast({exact(column, data_type)} AS double), 0D)"
    return f"if({column} IS NULL, NULL, 0D)"


def total(exact_sum: str, remainder_sum: str) -> str:
    """Both sums together; NULL if there was no value."""
    return f"coalesce(cast({exact_sum} AS double), 0D) + {remainder_sum}"


def mean(total: str, count: str) -> str:
    return f"({total}) / nullif({count}, 0)"


def squares_of_means(price: str) -> str:
    """What a partial row adds to the sum of squares if all its values were their mean."""
    whole = total(f"sum_{price}", f"rest_{price}")
    return f"({whole}) * ({whole}) / nullif(n_{price}, 0)"


def merged_deviations(price: str) -> str:
    """Squared deviations from the common mean, summed over partial rows.

    Each row brings those from its own mean; those of the means are added (never less than 0,
    as rounding could have it).
    """
    whole = total(f"sum(sum_{price})", f"sum(rest_{price})")
    between = f"sum({squares_of_means(price)}) - ({whole}) * ({whole}) / nullif(sum(n_{price}), 0)"
    return f"sum(m2_{price}) + greatest({between}, 0D)"


def sample_variance(deviations: str, count: str) -> str:
    """NULL for fewer than two values."""
    return f"CASE WHEN {count} > 1 THEN ({deviations}) / ({count} - 1) END"


def total_count(column: str) -> str:
    """Sum of a count column; no rows means 0."""
    return f"coalesce(sum({column}), 0)"


def first_partials(schema: T.StructType) -> list[str]:
    """Partial measures over events: row count, and per price its count, both sums, min, max
    and squared deviations from the mean.
    """
    out = ["count(1) AS n_events"]
    for price in PRICES:
        out += [
            f"count({price}) AS n_{price}",
            f"sum({exact(price, schema[price].dataType)}) AS sum_{price}",
            f"sum({remainder(price, schema[price].dataType)}) AS rest_{price}",
            f"min({price}) AS min_{price}",
            f"max({price}) AS max_{price}",
            f"var_pop(cast({price} AS double)) * count({price}) AS m2_{price}",
        ]
    return out


def merged_partials() -> list[str]:
    """The same measures over partial rows, for a coarser grouping."""
    out = [f"{total_count('n_events')} AS n_events"]
    for price in PRICES:
        out.append(f"{total_count(f'n_{price}')} AS n_{price}")
        out.append(f"sum(rest_{price}) AS rest_{price}")
        out += [f"{f}({f}_{price}) AS {f}_{price}" for f in ("sum", "min", "max")]
        out.append(f"{merged_deviations(price)} AS m2_{price}")
    return out


def public_measure(name: str, priced: bool) -> str:
    """A reported measure from partial columns.

    ``priced`` tables count only rows that have a total price.
    """
    kind, _, price = name.partition("_")
    if name == "n_events" and priced:
        return "n_total_price"
    if kind == "avg":
        return mean(total(f"sum_{price}", f"rest_{price}"), f"n_{price}")
    if kind == "sum":
        return total(name, f"rest_{price}")
    if kind in ("min", "max"):
        return f"cast({name} AS double)"
    return name
