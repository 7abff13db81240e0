"""The normal quantile function as an SQL expression."""

from __future__ import annotations

# fixed values: coefficients of the published rational approximation AS 241, highest power last
CENTRAL = ([3.3871328727963666080e0, 1.3314166789178437745e+2, 1.9715909503065514427e+3,
            1.3731693765509461125e+4, 4.5921953931549871457e+4, 6.7265770927008700853e+4,
            3.3430575583588128105e+4, 2.5090809287301226727e+3],
           [1.0, 4.2313330701600911252e+1, 6.8718700749205790830e+2, 5.3941960214247511077e+3,
            2.1213794301586595867e+4, 3.9307895800092710610e+4, 2.8729085735721942674e+4,
            5.2264952788528545610e+3])
MIDDLE = ([1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0,
           3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1,
           2.27238449892691845833e-2, 7.74545014278341407640e-4],
          [1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
           1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4,
           1.05075007164441684324e-9])
FAR = ([6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0,
        2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3,
        2.71155556874348757815e-5, 2.01033439929228813265e-7],
       [1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
        7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7,
        2.04426310338993978564e-15])


def _ratio(parts: tuple[list[float], list[float]], x: str) -> str:
    def polynomial(terms: list[float]) -> str:
        out = f"{terms[-1]!r}" if "e" in repr(terms[-1]) else f"{terms[-1]!r}e0"
        for t in reversed(terms[:-1]):
            out = f"({out} * {x} + {t!r}{'' if 'e' in repr(t) else 'e0'})"
        return out

    return f"({polynomial(parts[0])} / {polynomial(parts[1])})"


def normal_quantile(p: str) -> str:
    """SQL for the standard normal quantile of ``p``, an SQL expression between 0 and 1."""
    tail = f"sqrt(-ln(least({p}, 1e0 - {p})))"
    side = f"CASE WHEN {p} < 0.5e0 THEN -1e0 ELSE 1e0 END"
    return (f"CASE WHEN abs({p} - 0.5e0) <= 0.425e0 THEN ({p} - 0.5e0) * "
            f"{_ratio(CENTRAL, f'(0.180625e0 - ({p} - 0.5e0) * ({p} - 0.5e0))')} "
            f"WHEN {tail} <= 5e0 THEN {side} * {_ratio(MIDDLE, f'({tail} - 1.6e0)')} "
            f"ELSE {side} * {_ratio(FAR, f'({tail} - 5e0)')} END")
