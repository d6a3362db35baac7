"""Personal data: patterns, and candidates judged by gradient-boosted trees. DataFrame functions only, whole texts, no shuffle.

Base spans are the leftmost non-overlapping matches of a pattern for each kind, less those that fail the kind's test (parts of an address up to 255; 12 to
19 digits that pass the Luhn test; 9 to 15 digits of a phone number). Candidates come from loose patterns of the same kinds (obfuscated
addresses, numbers without a plus sign, other separators) and of one more kind, secrets (keys, tokens and passwords, of which the contract of base spans
knows nothing), and may overlap; those that touch no base span get features of their form and of the text around them. Boosted trees, turned into column expressions, score them; a kind's threshold is the lowest score at
which a held-out part of the labelled rows had a precision of PRECISION. Of overlapping accepted candidates the best stays.

The trees are fitted on LABELLED made-up rows (templates filled with digits and words, by the same feature expressions); this bound does not
depend on the documents. held_out_quality() measures them on templates of other wordings and forms, which no tree has seen. All else covers every text.

The patterns are written so that no match attempt is repeated inside a run of characters that has failed (look-behind, possessive repeats),
so very long runs take linear time and no deep recursion; they match what the plain patterns match.

Positions are code points. Cases: a null or empty text has no spans; repeated rows are judged one by one; an empty table gives an empty result;
other columns are kept by redacted(), whatever their names; the columns that find() adds replace ones of the same names.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import named, packed, unpacked

KINDS = ["email", "ip", "card", "phone"]
ALL_KINDS = [*KINDS, "secret"]
#: Rows made up for fitting; thresholds are set on the last third.
LABELLED = 12_000
PRECISION, TREES, DEPTH, RATE = 0.995, 40, 3, 0.3

_NAME = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_NAME}]))[{_NAME}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CANDIDATES = {
    "email": rf"(?<![{_NAME}])[{_NAME}]++(?i:\x20?(?:@|[\[({{<]at[\])}}>])\x20?|\x20at\x20|_at_)[A-Za-z0-9-]++(?i:(?:\x20?(?:\.|[\[({{<]dot[\])}}>])\x20?|\x20dot\x20|_dot_)[A-Za-z]{{2,24}}+)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\x20?(?:\[\.\]|\(\.\)|[.,]|\x20dot)\x20?[0-9]{1,3}){3}(?![0-9.])",
    "card": r"(?<![0-9])[0-9](?:[\x20._/-]{0,2}[0-9]){11,18}(?![0-9])",
    "phone": r"(?<![0-9+])(?:\(?[0-9]{2,5}\)?[\x20./-]\x20?){1,4}[0-9]{2,4}(?:[\x20.-]?[0-9]{2,5}){1,2}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]{0,40}[0-9])[A-Za-z0-9+/_-]{12,256}+={0,2}(?![A-Za-z0-9+/_@-])",
}
#: What a text must hold for a pattern to be tried at all.
_HINT = {"email": "@", "phone": "+", "email?": r"(?i)@|\bat\b|_at_", "digits": "[0-9]"}
AROUND = 24


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value) with value worked out once."""
    return F.element_at(F.transform(F.array(value), then), 1)


_FOUND = "array<struct<start: int, end: int, value: string, left: string, right: string>>"


def located(text: Column, pattern: str) -> Column:
    """All matches with positions and surroundings: the text is split at the matches, and lengths add up."""

    def walk(found: Column, between: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            gap = between[i]
            start = acc["at"] + F.length(gap)
            end = start + F.length(found[i])
            here = F.struct(start.alias("start"), end.alias("end"), found[i].alias("value"), F.substring(gap, -AROUND, AROUND).alias("left"), F.substring(between[i + 1], 1, 1).alias("right"))
            return F.struct(end.alias("at"), F.array_append(acc["out"], here).alias("out"))

        zero = F.struct(F.lit(0).alias("at"), F.array().cast(_FOUND).alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), zero, step)["out"]

    return let(F.regexp_extract_all(text, F.lit(pattern), 0), lambda m: F.when(F.size(m) > 0, let(F.split(text, pattern, -1), lambda p: walk(m, p))).otherwise(F.array().cast(_FOUND)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _byte(part: Column) -> Column:
    number = F.regexp_replace(part, "^0+", "")
    return (F.length(number) <= 3) & (F.concat(F.lit("0"), F.substring(number, 1, 3)).cast("int") <= 255)


def _holds(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), _byte)
    if kind == "card":
        return let(_digits(value), lambda d: F.length(d).between(12, 19) & F.call_function("luhn_check", d))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _none() -> Column:
    return F.array().cast("array<struct<start: int, kind: int, end: int>>")


def base_spans(text: Column) -> Column:
    """array<struct<start, kind (its place in KINDS), end>>, by start, then kind."""

    def of_kind(i: int, kind: str) -> Column:
        good = F.filter(located(text, BASE[kind]), lambda c: _holds(kind, c["value"]))
        spans = F.transform(good, lambda c: F.struct(c["start"].alias("start"), F.lit(i).alias("kind"), c["end"].alias("end")))
        has = F.contains(text, F.lit(_HINT[kind])) if kind in _HINT else text.rlike(_HINT["digits"])
        return F.when(has, spans).otherwise(_none())

    return F.array_sort(F.concat(*[of_kind(i, kind) for i, kind in enumerate(KINDS)]))


def features(kind: Column, value: Column, left: Column, right: Column) -> Column:
    """Numbers that describe a candidate's form and context, as an array of doubles."""
    count = lambda pattern: F.regexp_count(value, F.lit(pattern))
    near = lambda pattern: F.lower(left).rlike(pattern)
    digits = _digits(value)
    groups = F.regexp_replace(F.regexp_replace(value, "[0-9]", "9"), "[^9]+", "-")
    parts = F.filter(F.split(value, "[^0-9]+"), lambda x: x != "")
    listed = [
        kind,
        F.length(value),
        F.length(digits),
        F.size(parts),
        F.length(digits).between(12, 19) & F.call_function("luhn_check", digits),
        count(r"[()]"),
        count(r"\x20"),
        count(r"\."),
        count("-"),
        count(","),
        count(r"\[at\]|\(at\)|@"),
        count(r"\[dot\]|\(dot\)|\[\.\]|\(\.\)"),
        count(r"\x20at\x20"),
        count(r"\x20dot\x20"),
        near(r"phone|tel|call|mobil|fax|dial|sms|handy|fon|ring|ruf|llam|appel"),
        near(r"card|visa|master|credit|debit|amex|pay"),
        near(r"mail|contact|write|send|reach|kontakt|schreib|escrib|correo"),
        near(r"\bip\b|host|server|addr|client|ping"),
        near(r"[a-z0-9_]$"),
        right.rlike("[A-Za-z0-9_]"),
        value.rlike(r"^(?:19|20)[0-9]{2}[^0-9]"),
        F.lower(value).rlike(r"(?:com|org|net|edu|gov|io|de|fr|es|info)$"),
        groups.rlike("^9999-9999-9999-9999(?:-9{1,3})?$"),
        groups.rlike("^-?999-999-9999$"),
        F.forall(parts, _byte),
        near(r"[$€£#=:/_-]\s*$"),
        near(r"(?:secret|token|passw(?:or)?d|pwd|passphrase|credential|bearer|(?:api|access|auth|private|signing)[\x20_-]?key|\bkey)[\"']?\s{0,2}(?:[:=]|is)?\s{0,2}[\"']?$"),
        near(r"[\"']$"),
        count("/"),
        count("_"),
        count("[A-Z]"),
        count("[0-9][A-Za-z]"),
        count("[A-Za-z]{5}"),
        value.rlike("^[0-9a-f]+$"),
        value.rlike("^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"),
        near(r"commit|sha|md5|hash|digest|checksum|uuid|revision"),
        value.startswith("0"),
        groups.rlike("^-?99-99-99-99-99$"),
    ]
    return F.array(*[c.cast("double") for c in listed])


def _templates(held_out: bool) -> tuple[list[tuple[int, str, int]], dict[int, list[str]], list[str]]:
    """(kind, value, label) templates, words that announce each kind, and words that announce none. Those of `held_out` share no form and no announcement with the others."""
    d = lambda a, k: f"substr(d, {a}, {k})"
    octet = lambda k: f"cast(pmod(xxhash64(id, {k}), 256) as string)"
    small = lambda k: f"cast(pmod(xxhash64(id, {k}), 60) as string)"
    valid = "concat(d15, element_at(filter(array('0','1','2','3','4','5','6','7','8','9'), c -> luhn_check(concat(d15, c))), 1))"
    cut = lambda s, sep: f"concat_ws('{sep}', substr({s}, 1, 4), substr({s}, 5, 4), substr({s}, 9, 4), substr({s}, 13, 4))"
    mixed = "translate(sha2(concat('m', id), 256), '0123456789abcdef', 'aK3dZx7Qm9Rt2Wp5')"
    if held_out:
        rows = [
            (0, "concat(upper(w), ' AT ', w2, ' DOT ', tld)", 1), (0, f"concat(w, '_', w2, {d(1, 2)}, '<at>', w, '<dot>', tld)", 1), (0, "concat(w, ' (at) ', w2, ' (dot) ', tld)", 1),
            (0, "concat(w, ' at ', w2, '. ', w)", 0), (0, "concat(w2, ' at ', w, ' dot ', w2)", 0),
            (1, f"concat_ws(' dot ', {octet(1)}, {octet(2)}, {octet(3)}, {octet(4)})", 1), (1, f"concat({octet(1)}, '[.]', {octet(2)}, '[.]', {octet(3)}, '.', {octet(4)})", 1), (1, f"concat_ws(', ', {octet(1)}, {small(2)}, {small(3)}, {octet(4)})", 0),
            (2, cut(valid, "-/"), 1), (2, cut(valid, ". "), 1), (2, cut("d", "_"), 0), (2, "substr(d, 5, 16)", 0),
            (3, f"concat('0', {d(1, 2)}, ' ', {d(4, 7)})", 1), (3, f"concat('0', {d(1, 3)}, '/', {d(4, 7)})", 1), (3, f"concat_ws('-', {d(1, 4)}, {d(5, 3)}, {d(8, 3)})", 1),
            (3, f"concat('18', {d(1, 2)}, '/', {d(3, 2)}, ' ', {d(5, 4)})", 0), (3, f"concat_ws(' ', {d(1, 3)}, {d(4, 3)}, {d(7, 3)})", 0),
            (4, "substr(sha2(concat('h', id), 256), 1, 40)", 1), (4, f"concat('sk_', substr({mixed}, 1, 28))", 1), (4, "substr(sha2(concat('h', id), 256), 1, 40)", 0), (4, "concat(w, '/', w2, '/', w, substr(d, 1, 3), '/', w2)", 0),
        ]
        about = {0: ["Kontakt: ", "reach them on "], 1: ["ping ", "client at "], 2: ["amex no ", "paid by mastercard "], 3: ["Telefon ", "Handy: ", "mobile "], 4: ["passwd: ", 'bearer ', "the signing key is "]}
        return rows, about, ["of ", "revision ", "with ", "No ", "- "]
    rows = [
        (0, f"concat(w, {d(1, 2)}, ' [at] ', w2, '.', tld)", 1), (0, "concat(w, '(at)', w2, '(dot)', tld)", 1), (0, f"concat(w, '.', w2, {d(1, 2)}, ' @ ', w2, '.', tld)", 1), (0, "concat(w, ' at ', w2, ' dot ', tld)", 1), (0, "concat(w, '{at}', w2, '.', tld)", 1), (0, "concat(w, '_at_', w2, '_dot_', tld)", 1),
        (0, "concat(w, ' at ', w2, '.', w)", 0), (0, "concat(w, ' at ', w2, ' . ', w)", 0), (0, "concat(w, ' at ', w2, '.', w2, '.', w)", 0), (0, "concat(w, ' at ', w2, ' dot ', w)", 0), (0, "concat(w, ' @ ', w2, '. ', w)", 0),
        (1, f"concat_ws('[.]', {octet(1)}, {octet(2)}, {octet(3)}, {octet(4)})", 1), (1, f"concat_ws('(.)', {octet(1)}, {octet(2)}, {octet(3)}, {octet(4)})", 1), (1, f"concat_ws(' [.] ', {octet(1)}, {octet(2)}, {octet(3)}, {octet(4)})", 1), (1, f"concat({octet(1)}, '.', {octet(2)}, '(.)', {octet(3)}, ' dot ', {octet(4)})", 1),
        (1, f"concat_ws(', ', {small(1)}, {small(2)}, {small(3)}, {small(4)})", 0), (1, f"concat_ws(',', {octet(1)}, {small(2)}, {octet(3)}, {small(4)})", 0), (1, f"concat({small(1)}, '.', {small(2)}, ', ', {small(3)}, '.', {small(4)})", 0), (1, f"concat_ws('. ', {small(1)}, {small(2)}, {small(3)}, {small(4)})", 0),
        (2, cut(valid, "."), 1), (2, cut(valid, "_"), 1), (2, cut(valid, "/"), 1), (2, cut(valid, "  "), 1), (2, cut(valid, " -"), 1),
        (2, cut("d", "."), 0), (2, cut("d", " "), 0), (2, f"concat_ws('-', '20', {d(1, 6)}, {d(7, 6)})", 0), (2, "substr(d, 1, 14)", 0), (2, "substr(d, 3, 18)", 0), (2, f"concat_ws('.', {d(1, 5)}, {d(6, 5)}, {d(11, 5)})", 0), (2, f"concat({d(1, 1)}, '/', {d(2, 2)}, '/', {d(4, 4)}, ' ', {d(9, 6)})", 0),
        (3, f"concat('(', {d(1, 3)}, ') ', {d(4, 3)}, '-', {d(7, 4)})", 1), (3, f"concat_ws('-', {d(1, 3)}, {d(4, 3)}, {d(7, 4)})", 1), (3, f"concat_ws('.', {d(1, 3)}, {d(4, 3)}, {d(7, 4)})", 1), (3, f"concat('0', {d(1, 4)}, ' ', {d(5, 6)})", 1), (3, f"concat('(0', {d(1, 2)}, ') ', {d(4, 6)})", 1), (3, f"concat('0', {d(1, 2)}, ' / ', {d(4, 3)}, ' ', {d(7, 4)})", 1), (3, f"concat_ws(' ', concat('0', {d(1, 1)}), {d(2, 2)}, {d(4, 2)}, {d(6, 2)}, {d(8, 2)})", 1), (3, f"concat_ws('-', concat('0', {d(1, 2)}), {d(3, 3)}, {d(6, 4)})", 1),
        (3, f"concat_ws('-', '19', {d(1, 2)}, {d(3, 4)})", 0), (3, f"concat('20', {d(1, 2)}, '-', {d(3, 2)}, '-', {d(5, 4)})", 0), (3, f"concat_ws(' ', {d(1, 2)}, {d(3, 3)}, {d(6, 3)}, {d(9, 3)})", 0), (3, f"concat({d(1, 3)}, '-', {d(4, 3)}, ' ', {d(7, 3)})", 0), (3, f"concat_ws('.', {d(1, 2)}, {d(3, 4)}, {d(7, 4)})", 0), (3, f"concat_ws('-', '978', {d(1, 2)}, {d(3, 4)}, {d(7, 4)})", 0), (3, f"concat_ws(' ', {d(1, 4)}, {d(5, 4)}, {d(9, 4)})", 0), (3, f"concat({d(1, 2)}, '/', {d(3, 2)}, '/', {d(5, 4)} , ' ', {d(9, 4)})", 0), (3, f"concat('1', {d(1, 2)}, '/', {d(4, 6)})", 0),
        (4, "substr(sha2(cast(id as string), 256), 1, 32)", 1), (4, "sha2(cast(id as string), 256)", 1), (4, f"concat('ghp_', substr({mixed}, 1, 36))", 1), (4, f"concat('AKIA', upper(substr({mixed}, 1, 16)))", 1), (4, f"substr({mixed}, 1, 20)", 1), (4, "concat(w, substr(d, 1, 4), upper(w2), substr(d, 5, 4))", 1),
        (4, "substr(sha2(cast(id as string), 256), 1, 40)", 0), (4, "substr(sha2(cast(id as string), 256), 1, 16)", 0), (4, "concat_ws('-', substr(sha2(cast(id as string), 256), 1, 8), substr(sha2(cast(id as string), 256), 9, 4), substr(sha2(cast(id as string), 256), 13, 4), substr(sha2(cast(id as string), 256), 17, 4), substr(sha2(cast(id as string), 256), 21, 12))", 0), (4, "concat(w, '/', w2, substr(d, 1, 2), '/', w)", 0), (4, "concat(w, '-', w2, '-', substr(d, 1, 4), '-', w)", 0), (4, "concat(w, '_', w2, '_v', substr(d, 1, 1))", 0), (4, "substr(d, 1, 14)", 0),
    ]
    about = {0: ["mail me: ", "contact ", "write to "], 1: ["server ", "host ip ", "addr: "], 2: ["card ", "credit card: ", "visa "], 3: ["call ", "tel: ", "phone ", "fax "], 4: ['token = "', "api_key: ", "password is ", "secret='", "access key "]}
    return rows, about, ["", "and then ", "no. ", "the ", "see ", "= ", "of them ", "commit ", "sha256:", '"']


def _made_up(spark: SparkSession, n: int, held_out: bool = False) -> DataFrame:
    """Labelled candidates from templates: kind, value, left, right, label. Words and digits come from a hash of the row number."""
    rows, about, plain = _templates(held_out)
    words = ", ".join(f"'{x}'" for x in ["anna", "home", "river", "noon", "market", "office", "paul", "garden", "school", "lake", "they", "was", "looked", "sales", "info"])
    first = 10_000_000 if held_out else 0
    base = spark.range(first, first + n).selectExpr(
        "id", f"cast(pmod(xxhash64(id, 11), {len(rows)}) as int) t", "substr(translate(sha2(cast(id as string), 256), 'abcdef', '012345'), 1, 40) d",
        f"element_at(array({words}), cast(pmod(xxhash64(id, 12), 15) as int) + 1) w", f"element_at(array({words}), cast(pmod(xxhash64(id, 13), 15) as int) + 1) w2", "element_at(array('com', 'org', 'net', 'edu', 'io', 'de'), cast(pmod(xxhash64(id, 14), 6) as int) + 1) tld", "cast(pmod(xxhash64(id, 15), 100) as int) c",
    ).withColumn("d15", F.expr("concat('4', substr(d, 2, 14))"))
    pick = lambda listed, salt: "element_at(array(" + ", ".join("'" + x.replace("'", "\\'") + "'" for x in listed) + f"), cast(pmod(xxhash64(id, {salt}), {len(listed)}) as int) + 1)"
    told = lambda kind, label: (100 if kind == 4 else 75) if label else (0 if kind == 4 else 10)  # noqa: E731  # a secret is one by what announces it
    left = " ".join(f"WHEN t = {i} AND c < {told(kind, label)} THEN {pick(about[kind], 16)}" for i, (kind, _, label) in enumerate(rows))
    return base.selectExpr(
        f"CASE {' '.join(f'WHEN t = {i} THEN {kind}' for i, (kind, _, _) in enumerate(rows))} END kind",
        f"CASE {' '.join(f'WHEN t = {i} THEN {value}' for i, (_, value, _) in enumerate(rows))} END value",
        f"CASE {left} ELSE {pick(plain, 17)} END `left`",
        f"{pick([' ', '.', ',', '', ';'], 18)} `right`",
        f"CASE {' '.join(f'WHEN t = {i} THEN {label}' for i, (_, _, label) in enumerate(rows))} END label",
    )


def _tree(bins: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, depth: int):
    """(feature, threshold, below, above) or a leaf's value, by the gain of a Newton step. bins: a row per feature, the place of each value among its cuts."""
    g, h = grad[rows].sum(), hess[rows].sum()
    best = (1e-3, None)
    if depth:
        for j, of in enumerate(cuts):
            if len(of):
                low_g, low_h = (np.cumsum(np.bincount(bins[j, rows], x[rows], len(of) + 1))[:-1] for x in (grad, hess))
                gain = low_g**2 / (low_h + 1) + (g - low_g) ** 2 / (h - low_h + 1) - g**2 / (h + 1)
                at = int(gain.argmax())
                if gain[at] > best[0]:
                    best = (gain[at], (j, at))
    if best[1] is None:
        return float(-RATE * g / (h + 1))
    j, at = best[1]
    low = bins[j, rows] <= at
    return (j, float(cuts[j][at]), _tree(bins, cuts, grad, hess, rows[low], depth - 1), _tree(bins, cuts, grad, hess, rows[~low], depth - 1))


def _apply(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    return np.where(x[:, tree[0]] <= tree[1], _apply(tree[2], x), _apply(tree[3], x))


def _expression(tree, x: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    return F.when(x[tree[0]] <= tree[1], _expression(tree[2], x)).otherwise(_expression(tree[3], x))


_fitted: list[tuple[list, list[float]]] = []


def fitted(spark: SparkSession) -> tuple[list, list[float]]:
    """The trees, and a threshold for each kind. The rows are always the same, so a process fits once."""
    if not _fitted:
        made = _made_up(spark, LABELLED)
        rows = made.select(features(F.col("kind"), F.col("value"), F.col("left"), F.col("right")).alias("x"), "label").collect()
        x, y = np.array([r.x for r in rows]), np.array([r.label for r in rows], float)
        n = len(x) * 2 // 3
        values = [np.unique(c) for c in x[:n].T]
        cuts = [v[:-1][:: max(1, len(v) // 24)] for v in values]
        bins = np.stack([np.searchsorted(of, c) for of, c in zip(cuts, x[:n].T, strict=True)])
        score, trees = np.zeros(n), []
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            trees.append(_tree(bins, cuts, p - y[:n], p * (1 - p), np.arange(n), DEPTH))
            score += _apply(trees[-1], x[:n])
        held = sum(_apply(t, x[n:]) for t in trees)
        limits = []
        for k in range(len(ALL_KINDS)):
            of = x[n:, 0] == k
            order = np.argsort(-held[of], kind="stable")
            precise = np.cumsum(y[n:][of][order]) / np.arange(1, of.sum() + 1) >= PRECISION
            limits.append(float(max(held[of][order][np.flatnonzero(precise)[-1]], 0.0)) if precise.any() else float("inf"))
        _fitted.append((trees, limits))
    return _fitted[0]


def held_out_quality(spark: SparkSession, n: int = 4000) -> dict[str, tuple[int, float, float, float]]:
    """For each kind, over n made-up rows of templates that were not fitted on: positives, recall and precision of the trees, and recall of the base patterns."""
    trees, limits = fitted(spark)
    text = F.concat("left", "value", "right")
    base = F.exists(base_spans(text), lambda b: (b["start"] < F.length("left") + F.length("value")) & (b["end"] > F.length("left")))
    rows = _made_up(spark, n, held_out=True).select("kind", "label", "left", "value", "right", base.alias("base"))
    rows = rows.withColumn("spans", added_spans(text, base_spans(text), trees, limits))
    hit = F.exists("spans", lambda s: (s["kind"] == F.col("kind")) & (s["start"] <= F.length("left")) & (s["end"] >= F.length("left") + F.length("value")))
    found = rows.groupBy("kind").agg(F.sum("label"), F.count_if(hit & (F.col("label") == 1)), F.count_if((F.size("spans") > 0)), F.count_if(F.col("base") & (F.col("label") == 1))).collect()
    return {ALL_KINDS[k]: (p, tp / p, tp / max(1, fired), b / p) for k, p, tp, fired, b in found}


def added_spans(text: Column, base: Column, trees: list, limits: list[float]) -> Column:
    """Candidates beside the base spans that the trees accept."""

    def of_kind(i: int, kind: str) -> Column:
        free = F.filter(located(text, CANDIDATES[kind]), lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (b["end"] > c["start"])))
        value = lambda c: let(features(F.lit(i), c["value"], c["left"], c["right"]), lambda x: sum((_expression(t, x) for t in trees), F.lit(0.0)))
        scored = F.transform(free, lambda c: F.struct(c["start"].alias("start"), F.lit(i).alias("kind"), c["end"].alias("end"), value(c).alias("score")))
        passed = F.filter(scored, lambda c: c["score"] >= limits[i])
        return F.when(text.rlike(_HINT["email?" if kind == "email" else "digits"]), passed).otherwise(F.array().cast("array<struct<start: int, kind: int, end: int, score: double>>"))

    parts = [of_kind(i, kind) for i, kind in enumerate(ALL_KINDS)]
    wins = lambda a, c: (a["start"] < c["end"]) & (a["end"] > c["start"]) & ((a["score"] > c["score"]) | ((a["score"] == c["score"]) & (F.struct(a["start"], a["kind"], a["end"]) < F.struct(c["start"], c["kind"], c["end"]))))
    best = let(F.concat(*parts), lambda all_: F.filter(all_, lambda c: ~F.exists(all_, lambda a: wins(a, c))))
    return F.transform(best, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))


def _spans(text: Column, trees: list, limits: list[float]) -> Column:
    """struct<base, spans>."""
    return let(base_spans(text), lambda b: F.struct(b.alias("base"), F.array_sort(F.concat(b, added_spans(text, b, trees, limits))).alias("spans")))


def _kind(number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, ALL_KINDS)), number + 1)


def find(docs: DataFrame) -> DataFrame:
    """docs with `base` and `spans` (base and accepted candidates): arrays of start, kind (its place in ALL_KINDS) and end by start, then kind."""
    trees, limits = fitted(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = docs.select(packed(*[named(c) for c in docs.columns]), let(text, lambda t: _spans(t, trees, limits)).alias("found"))
    return found.select(*unpacked(found, ["base", "spans"]), "found.base", "found.spans")


def redacted(docs: DataFrame) -> DataFrame:
    """docs with every span of the text replaced by its kind in brackets."""
    trees, limits = fitted(docs.sparkSession)

    def clean(text: Column) -> Column:
        def step(acc: Column, s: Column) -> Column:
            so_far = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), _kind(s["kind"]), F.lit("]"))
            return F.when(s["start"] < acc["at"], F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))).otherwise(F.struct(s["end"].alias("at"), so_far.alias("out")))

        def rest(acc: Column) -> Column:
            return F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))

        return F.aggregate(_spans(text, trees, limits)["spans"], F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, rest)

    text = F.col("text").cast("string")
    return docs.withColumn("text", F.when(text.isNotNull(), let(text, clean)))


def spelled(spans: Column) -> Column:
    """kind:start:end of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", _kind(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def counts(docs: DataFrame) -> DataFrame:
    """A row per row of docs: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256 and spans, spelled out."""
    found = find(docs.select("doc_id", "text"))
    number = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    numbers = [number(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *numbers, F.sha2(spelled(F.col("base")), 256).alias("base_sha256"), spelled(F.col("spans")).alias("spans"))
