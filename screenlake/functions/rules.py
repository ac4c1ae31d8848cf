"""Declarative rule filters: a rule is a list of (property, op, bound) conditions, ANDed.

Bounds are closed (<=, between); a missing property makes the rule false.  Each rule
becomes one boolean Column, so a rule set is a single projection (no Python per row).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Condition = tuple[str, str, object]

# Fixed values (document-scale limits, our own choice; the rule shapes follow the
# reference: closed upper bounds, closed ranges, AND across conditions).
RULES: dict[str, list[Condition]] = {
    "lipinski": [("n_chars", "<=", 20000), ("word_count", "<=", 3000), ("digit_share", "<=", 0.05),
                 ("line_count", "<=", 200), ("upper_share", "<=", 0.1)],
    "ghose": [("n_chars", "between", (200, 50000)), ("mean_word_len", "between", (3, 8)),
              ("word_count", "between", (20, 5000)), ("distinct_share", "between", (0.2, 0.9))],
    "veber": [("line_count", "<=", 100), ("digit_share", "<=", 0.02)],
}

# The reference's rules on its property names, and the names of a whole record.
PROPERTIES = ["molecular_weight", "logp", "h_bond_donor", "h_bond_acceptors", "rotatable_bonds", "num_atoms", "molar_refractivity",
              "topo_surface_area"]
COMPOUND_RULES: dict[str, list[Condition]] = {
    "lipinski": [("molecular_weight", "<=", 500), ("logp", "<=", 5), ("h_bond_donor", "<=", 5), ("h_bond_acceptors", "<=", 10),
                 ("rotatable_bonds", "<=", 5)],
    "ghose": [("molecular_weight", "between", (160, 480)), ("logp", "between", (-0.4, 5.6)), ("num_atoms", "between", (20, 70)),
              ("molar_refractivity", "between", (40, 130))],
    "veber": [("rotatable_bonds", "<=", 10), ("topo_surface_area", "<=", 140)],
}


def condition(prop: str, op: str, bound) -> Column:
    c = F.col(prop)
    if op == "<=":
        return c <= F.lit(bound)
    if op == ">=":
        return c >= F.lit(bound)
    if op == "between":
        lo, hi = bound
        return c.between(F.lit(lo), F.lit(hi))
    raise ValueError(f"unknown operator {op}")


def rule(conditions: list[Condition]) -> Column:
    return F.coalesce(reduce(lambda a, b: a & b, [condition(*c) for c in conditions]), F.lit(False))


def rule_columns(rules: dict[str, list[Condition]] = RULES, valid: Column | None = None) -> list[Column]:
    """One flag per rule plus ``pass_all_filters``; invalid rows fail every rule."""
    flags = {name: rule(conds) for name, conds in rules.items()}
    if valid is not None:
        flags = {n: F.coalesce(valid, F.lit(False)) & f for n, f in flags.items()}
    cols = [f.alias(n) for n, f in flags.items()]
    cols.append(reduce(lambda a, b: a & b, flags.values()).alias("pass_all_filters"))
    return cols


def rule_sql(rules: dict[str, list[Condition]] = RULES) -> str:
    """The same rule set as SQL select items (for the oracle)."""
    def cond(p, op, b):
        if op == "between":
            return f"({p} BETWEEN {b[0]} AND {b[1]})"
        return f"({p} {op} {b})"
    items = {n: "coalesce(" + " AND ".join(cond(*c) for c in cs) + ", false)" for n, cs in rules.items()}
    out = [f"{v} AS {n}" for n, v in items.items()]
    out.append("(" + " AND ".join(items.values()) + ") AS pass_all_filters")
    return ",\n       ".join(out)
