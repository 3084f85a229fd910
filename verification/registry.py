"""Registry of queries and SQL helpers shared by the oracle."""

import functools
from collections.abc import Callable

from pitchlake.session import configure

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; with no SQL only its rows are checked by the driver."""

    def add(fn: Callable) -> Callable:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")

        @functools.wraps(fn)
        def run(spark, sf_dir):
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def half_up(num: str, den: str, digits: int = 2, factor: int = 1) -> str:
    """Exact num*factor/den rounded half away from zero, from integers; NULL for den 0."""
    scale = 10**digits
    n = f"(abs({num})::HUGEINT * {2 * scale * factor})"
    d = f"({den})::HUGEINT"
    return (
        f"(sign({num}) * CAST(({n} + {d}) // nullif(2 * {d}, 0) AS BIGINT) / {scale}.0::DOUBLE)"
    )


def pct(num: str, den: str) -> str:
    return f"coalesce({half_up(num, den, factor=100)}, 0.0)"
