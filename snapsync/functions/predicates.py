"""SQL predicates that each row of a table meets once, as text for any database."""

from __future__ import annotations

from collections.abc import Callable, Sequence


def bound_predicates(column: str, cuts: Sequence) -> list[str]:
    """One SQL predicate per range between literals in ascending order."""
    if not cuts:
        return ["1 = 1"]
    return [
        f"({column} < {cuts[0]} OR {column} IS NULL)",
        *(f"({column} >= {a} AND {column} < {b})" for a, b in zip(cuts, cuts[1:])),
        f"({column} >= {cuts[-1]})",
    ]


def hash_remainders(hashed: str, n: int, modulo: str = "MOD({}, {})") -> list[str]:
    """``n`` SQL predicates by remainder of a hash; rows without a hash go with remainder 0."""
    remainder = modulo.format(hashed, n)
    first = f"({remainder} = 0 OR {hashed} IS NULL)"
    return [first, *(f"({remainder} = {i})" for i in range(1, n))]


def hot_bound_predicates(
    column: str, cuts: Sequence[str], pieces: Callable[[int], list[str] | None]
) -> list[str]:
    """As ``bound_predicates``, of cuts that may repeat: such a value holds several shares.

    It is read by itself, in as many queries as it has shares, told apart by ``pieces(n)``,
    predicates over other columns; None if there are none.
    """
    distinct = list(dict.fromkeys(cuts))
    found: list[str] = []
    for i, rows in enumerate(bound_predicates(column, distinct)):
        shares = cuts.count(distinct[i - 1]) if i else 1
        inner = pieces(shares) if shares > 1 else None
        if not inner:
            found.append(rows)
            continue
        found += [f"({column} = {distinct[i - 1]}) AND {p}" for p in inner]
        # What follows the value in its range. It is compared as the database does, so a
        # value that is equal to it in another writing goes with it.
        found.append(f"({rows} AND {column} > {distinct[i - 1]})")
    return found
