"""Checking SQL for small linear systems and the models that rest on them."""

from __future__ import annotations

from collections.abc import Sequence


def solve(source: str, n: int, rhs: Sequence[str], keep: Sequence[str] = ()) -> dict[str, str]:
    """Steps that eliminate column by column; each row of ``source`` is a system of its own.

    ``source`` has ``a<i>_<j>`` and a right side ``b<i>_<name>`` for each name; the last
    step, ``<source>_x``, has the solutions ``x<i>_<name>`` and the kept columns.
    """
    steps, before = {}, source
    for k in range(n):
        new = []
        for i in range(n):
            new += [f"a{i}_{i}"] if i <= k else []
            for column, own in [(f"a{i}_{j}", f"a{k}_{j}") for j in range(k + 1, n)] + [(f"b{i}_{r}", f"b{k}_{r}") for r in rhs]:
                new.append(column if i == k else f"{column} - a{i}_{k} / a{k}_{k} * {own} AS {column}")
        steps[f"{source}_{k}"] = f"SELECT {', '.join([*keep, *dict.fromkeys(new)])} FROM {before}"
        before = f"{source}_{k}"
    found = [f"b{i}_{r} / a{i}_{i} AS x{i}_{r}" for i in range(n) for r in rhs]
    steps[f"{source}_x"] = f"SELECT {', '.join([*keep, *found])} FROM {before}"
    return steps


def products(xs: Sequence[str], weight: str = "1.0") -> str:
    """Sums of products of the expressions, as ``a<i>_<j>``."""
    return ", ".join(f"sum({weight} * ({a}) * ({b})) AS a{i}_{j}" for i, a in enumerate(xs) for j, b in enumerate(xs))


def newton(rows: str, xs: Sequence[str], y: str, rounds: int, tag: str = "") -> dict[str, str]:
    """Steps of a logistic regression with a constant; ``beta<rounds>`` has ``c0..``, ``info`` the information there and a unit matrix.

    ``tag`` goes before the names of all steps, so that several models can stand side by side.
    """
    all_ = ["1.0", *xs]
    n = len(all_)
    steps = {f"{tag}beta0": "SELECT " + ", ".join(f"0.0::DOUBLE AS c{i}" for i in range(n))}
    for r in range(1, rounds + 1):
        eta = " + ".join(f"c{i} * ({x})" for i, x in enumerate(all_))
        steps[f"{tag}p{r}"] = f"SELECT *, 1 / (1 + exp(-({eta}))) AS p FROM {rows}, {tag}beta{r - 1}"
        sides = ", ".join(f"sum(({x}) * ({y} - p)) AS b{i}_g" for i, x in enumerate(all_))
        steps[f"{tag}s{r}"] = f"SELECT {products(all_, 'p * (1 - p)')}, {sides}, {', '.join(f'min(c{i}) AS c{i}' for i in range(n))} FROM {tag}p{r}"
        steps |= solve(f"{tag}s{r}", n, ["g"], [f"c{i}" for i in range(n)])
        steps[f"{tag}beta{r}"] = "SELECT " + ", ".join(f"c{i} + x{i}_g AS c{i}" for i in range(n)) + f" FROM {tag}s{r}_x"
    eta = " + ".join(f"c{i} * ({x})" for i, x in enumerate(all_))
    unit = ", ".join(f"{float(i == j)} AS b{i}_{j}" for i in range(n) for j in range(n))
    steps[f"{tag}fitted"] = f"SELECT *, 1 / (1 + exp(-({eta}))) AS p FROM {rows}, {tag}beta{rounds}"
    steps[f"{tag}info"] = f"SELECT {products(all_, 'p * (1 - p)')}, {unit} FROM {tag}fitted"
    return steps | solve(f"{tag}info", n, [str(j) for j in range(n)])


def newton_subsets(rows: str, xs: Sequence[str], y: str, rounds: int) -> dict[str, str]:
    """Logistic regressions on every subset of the columns at once: ``fit`` has ``m`` (bit i for column i), coefficients ``c0..`` and their variances ``v0..``.

    A column outside a subset counts as 0 with a unit row in the information, so its coefficient stays 0.
    """
    n = len(xs) + 1
    z = ["1.0", *[f"u{i} * ({x})" for i, x in enumerate(xs, 1)]]
    eta = " + ".join(f"c{i} * ({x})" for i, x in enumerate(z))
    weighted = ", ".join(
        f"sum(p * (1 - p) * ({a}) * ({b}))" + (f" + max(1 - u{i})" if i == j and i else "") + f" AS a{i}_{j}" for i, a in enumerate(z) for j, b in enumerate(z)
    )
    coefs = ", ".join(f"max(c{i}) AS c{i}" for i in range(n))
    steps = {
        "mk": "SELECT m, " + ", ".join(f"((m >> {i}) & 1)::DOUBLE AS u{i + 1}" for i in range(n - 1)) + f" FROM range(1, {2 ** (n - 1)}) r(m)",
        "beta0": "SELECT m, " + ", ".join(f"0.0::DOUBLE AS c{i}" for i in range(n)) + " FROM mk",
    }
    for r in range(1, rounds + 1):
        sides = ", ".join(f"sum(({x}) * ({y} - p)) AS b{i}_g" for i, x in enumerate(z))
        steps[f"p{r}"] = f"SELECT *, 1 / (1 + exp(-({eta}))) AS p FROM beta{r - 1} JOIN mk USING (m), {rows}"
        steps[f"s{r}"] = f"SELECT m, {weighted}, {sides}, {coefs} FROM p{r} GROUP BY m"
        steps |= solve(f"s{r}", n, ["g"], ["m", *[f"c{i}" for i in range(n)]])
        steps[f"beta{r}"] = "SELECT m, " + ", ".join(f"c{i} + x{i}_g AS c{i}" for i in range(n)) + f" FROM s{r}_x"
    unit = ", ".join(f"{float(i == j)} AS b{i}_{j}" for i in range(n) for j in range(n))
    steps["p"] = f"SELECT *, 1 / (1 + exp(-({eta}))) AS p FROM beta{rounds} JOIN mk USING (m), {rows}"
    steps["info"] = f"SELECT m, {weighted}, {unit}, {coefs} FROM p GROUP BY m"
    steps |= solve("info", n, [str(j) for j in range(n)], ["m", *[f"c{i}" for i in range(n)]])
    steps["fit"] = "SELECT m, " + ", ".join(f"c{i}, x{i}_{i} AS v{i}" for i in range(n)) + " FROM info_x"
    return steps


def upper_normal(z: str) -> str:
    """Both tails of the normal distribution beyond ``z``, by Simpson's rule over 2,000 steps."""
    weight = "CASE WHEN k IN (0, 2000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END"
    return f"(SELECT 1 - 2 / sqrt(2 * pi()) * abs({z}) / 2000 / 3 * sum({weight} * exp(-1 * (k * abs({z}) / 2000) * (k * abs({z}) / 2000) / 2)) FROM range(0, 2001) r(k))"
