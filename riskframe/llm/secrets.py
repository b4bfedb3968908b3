"""Secrets in texts, by Spark expressions only.

Three base patterns (assignments, access keys, hexadecimal runs) are found by regular
expressions. Beside them, candidate strings of each character class are searched with a
sliding window: the counts of the window's characters are kept while it moves by one, so
its Shannon entropy costs one step per character. Where windows reach the entropy asked
of the class, the span from the first to the last of them is reported, unless the
candidate is on an allow-list (identifiers, digests named as such, samples, alphabets).

Positions count code points, end exclusive. Cases: a null text is empty and has no spans;
equal rows get equal spans; an empty table gives an empty result; other columns are kept,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.frames import cols, fresh, quoted

# The base patterns, in the order in which spans with one start are listed.
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"  # runs are maximal, so a least length equals a later filter
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6
WINDOW = 20


@dataclass(frozen=True)
class CharacterClass:
    """A kind of candidate: the least bits of a window, and what it must match besides."""

    kind: str
    bits: float
    needs: str


@dataclass(frozen=True)
class Scan:
    """Candidates are runs of ``pattern``; ``alphabet`` lists the characters counted."""

    pattern: str
    alphabet: str
    classes: tuple[CharacterClass, ...]


_DIGITS = "0123456789"
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
# case changes that words joined in camel case seldom have
_UNEVEN = r"(?:[A-Z][a-z][A-Z]|[a-z][A-Z]{2}[a-z])"
# Bits of the last two classes: a window of 20 random characters has less in 0.6 % of
# cases (62 or 32 equally likely characters). What words alone have is asked for nowhere:
# a digit before a letter, or two uneven case changes, in a run that no mark interrupts.
SCANS = (
    Scan(
        r"(?<![0-9A-Za-z])[0-9A-Fa-f]{20,}(?![0-9A-Za-z])",
        _DIGITS + "abcdefABCDEF",
        (CharacterClass("entropy_hex", 3.0, r"[0-9]"),),
    ),
    Scan(
        r"[A-Za-z0-9+/_-]{20,}={0,2}",
        _LETTERS.upper() + _LETTERS + _DIGITS + "+/_-=",
        (
            CharacterClass("entropy_base64", 3.9, r"[0-9].*[0-9]"),
            CharacterClass(
                "entropy_mixed",
                3.6,
                rf"(?<![A-Za-z0-9])(?=[A-Za-z0-9]{{10}})[A-Za-z0-9]*(?:[0-9][A-Za-z]|{_UNEVEN}[A-Za-z0-9]*{_UNEVEN})",
            ),
        ),
    ),
    Scan(
        r"(?<![0-9A-Za-z])(?:[A-Z0-9]{20,}|[a-z0-9]{20,})(?![0-9A-Za-z])",
        _LETTERS.upper() + _LETTERS + _DIGITS,
        # without the first part it is hexadecimal
        (CharacterClass("entropy_base32", 3.3, r"^(?=.*[G-Zg-z]).*[0-9][A-Za-z]"),),
    ),
)

ALLOWED = (
    # identifiers
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$"
    # samples and alphabets
    r"|(?i)example|sample|placeholder|changeme|dummy|lorem|0123456789|abcdefghij|xxxxx"
    # digests named as such, and paths
    r"|^(?i)(sha(1|224|256|384|512)|md5)[-_=]|^/?[A-Za-z_-]+/[A-Za-z_-]+/"
)

KINDS = ("assign", "access", "hex", *(c.kind for scan in SCANS for c in scan.classes))
_SPAN = "array<struct<s: int, e: int, m: string>>"


def _matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches with their positions.

    The pieces between matches and the matches themselves alternate, so positions are
    running sums of their lengths.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.zip_with(
        F.split(text, pattern, -1), found, lambda gap, m: F.struct(F.length(gap).alias("gap"), m.alias("m"))
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(acc: Column, piece: Column) -> Column:
        s = acc["at"] + piece["gap"]
        e = s + F.coalesce(F.length(piece["m"]), F.lit(0))
        span = F.struct(s.alias("s"), e.alias("e"), F.coalesce(piece["m"], F.lit("")).alias("m"))
        return F.struct(
            e.alias("at"), F.when(piece["m"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(span))).alias("out")
        )

    none = F.array().cast(_SPAN)
    return F.when(text.rlike(pattern), F.aggregate(pieces, start, step, lambda acc: acc["out"])).otherwise(none)


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once, however often ``then`` names it."""
    return F.transform(F.array(value), then)[0]


def hot_windows(candidate: Column, alphabet: str, bits: list[float], window: int = WINDOW) -> Column:
    """For each of ``bits`` a struct(first, last): from where to where windows have as much entropy.

    With c the counts of a window of w characters, its entropy is
    log2(w) - sum(c * log2(c)) / w; moving the window changes two counts. Counts are five
    bits each, twelve to a number, so a step changes two numbers of a few. Whether a window
    is hot is asked when the next character comes, of the sum kept by then.
    """
    if window > 31:
        raise ValueError("a count has five bits")
    codes = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(alphabet), c) - 1)
    share = F.array(*[F.expr(f"{c} * log2({c})") if c > 1 else F.lit(0.0) for c in range(window + 2)])
    n_words = -(-(len(alphabet) + 1) // 12)
    # the sum must not exceed these
    least = [F.expr(f"log2({window}) - {b}D") * window + 1e-9 for b in bits]
    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), n_words).alias("counts"),
        F.lit(0.0).alias("total"),
        *[F.lit(-1).alias(f"{end}{k}") for k in range(len(bits)) for end in ("first", "last")],
    )

    def word(code: Column) -> Column:
        return F.floor(code / 12).cast("int")

    def one(code: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(code, F.lit(12)) * 5)

    def count(counts: Column, code: Column) -> Column:
        moved = F.call_function("shiftright", F.get(counts, word(code)), F.pmod(code, F.lit(12)) * 5)
        return moved.bitwiseAND(F.lit(31).cast("long")).cast("int")

    def ends(acc: Column, done: Column) -> list[Column]:
        """first and last of each class after ``done`` characters."""
        out = []
        for k, most in enumerate(least):
            hot = (done >= window) & (acc["total"] <= most)
            out.append(F.when(hot & (acc[f"first{k}"] < 0), done - window).otherwise(acc[f"first{k}"]).alias(f"first{k}"))
            out.append(F.when(hot, done).otherwise(acc[f"last{k}"]).alias(f"last{k}"))
        return out

    def scan(codes: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            # a character outside the alphabet has the last count
            come = F.get(codes, i)
            come = F.when(come < 0, len(alphabet)).otherwise(come)
            gone = F.get(codes, i - window)
            gone = F.when(gone < 0, len(alphabet)).otherwise(gone)
            full = i >= window
            a, b = count(acc["counts"], come), count(acc["counts"], gone)
            up = F.get(share, a + 1) - F.get(share, a)
            down = F.when(full, F.get(share, b) - F.get(share, b - 1)).otherwise(0.0)
            same = full & (come == gone)
            moved = F.transform(
                acc["counts"],
                lambda c, k: c
                + F.when(k == word(come), one(come)).otherwise(F.lit(0).cast("long"))
                - F.when(full & (k == word(gone)), one(gone)).otherwise(F.lit(0).cast("long")),
            )
            return F.struct(
                F.when(same, acc["counts"]).otherwise(moved).alias("counts"),
                F.when(same, acc["total"]).otherwise(acc["total"] + up - down).alias("total"),
                *ends(acc, i),
            )

        places = F.sequence(F.lit(0), F.size(codes) - 1)
        n = F.size(codes)
        return F.aggregate(
            places,
            start,
            step,
            lambda acc: _once(
                F.struct(*ends(acc, n)),
                lambda e: F.array(
                    *[F.struct(e[f"first{k}"].alias("first"), e[f"last{k}"].alias("last")) for k in range(len(bits))]
                ),
            ),
        )

    return _once(codes, scan)


def _entropy_spans(text: Column, scan: Scan) -> Column:
    """Candidates of a scan with the hot stretch of each of its classes, null where it has none."""

    def wanted(x: Column) -> Column:
        out = F.lit(False)
        for c in scan.classes:
            out = out | x["m"].rlike(c.needs)
        return out & ~x["m"].rlike(ALLOWED)

    def placed(x: Column) -> Column:
        hot = hot_windows(x["m"], scan.alphabet, [c.bits for c in scan.classes])

        def spans(h: Column) -> Column:
            return F.struct(
                *[
                    F.when(
                        (h[k]["first"] >= 0) & x["m"].rlike(c.needs),
                        F.struct((x["s"] + h[k]["first"]).alias("s"), (x["s"] + h[k]["last"]).alias("e")),
                    ).alias(c.kind)
                    for k, c in enumerate(scan.classes)
                ]
            )

        return _once(hot, spans)

    return F.transform(F.filter(_matches(text, scan.pattern), wanted), placed)


def find_secrets(df: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """``df`` with ``out``: an array of struct(start, rank, end, kind), by start, then kind."""
    body = F.coalesce(F.col(quoted(text)), F.lit(""))
    held = F.filter(
        _matches(body, ASSIGN), lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= LEAST_VALUE
    )
    searched = {"assign": held, "access": _matches(body, ACCESS), "hex": _matches(body, HEX)}
    names = dict(zip((*searched, *SCANS), fresh(df, *(f"_{k}" for k in (*searched, "scan1", "scan2", "scan3")))))
    columns = [c.alias(names[k]) for k, c in searched.items()]
    columns += [_entropy_spans(body, scan).alias(names[scan]) for scan in SCANS]

    def listed(kind: str) -> Column:
        """The spans of a kind, from the column that has them."""
        (of,) = [scan for scan in SCANS for c in scan.classes if c.kind == kind] or [kind]
        found = F.col(quoted(names[of]))
        if of is not kind:
            found = F.filter(F.transform(found, lambda x: x[kind]), lambda x: x.isNotNull())
        rank = KINDS.index(kind)
        return F.transform(
            found,
            lambda x: F.struct(
                x["s"].alias("start"), F.lit(rank).alias("rank"), x["e"].alias("end"), F.lit(kind).alias("kind")
            ),
        )

    every = F.array_sort(F.concat(*[listed(kind) for kind in KINDS]))
    return df.select(*cols(df.columns), *columns).select(*cols(df.columns), every.alias(out))


def as_text(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with every span of ``text`` replaced by ``<secret>``; touching spans are one."""
    (found,) = fresh(df, "_secrets")
    body, spans = F.col(quoted(text)), F.col(quoted(found))
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def step(acc: Column, x: Column) -> Column:
        before = F.substring(body, acc["at"] + 1, x["start"] - acc["at"])
        new = (x["start"] > acc["at"]) | (acc["at"] == 0)
        return F.struct(
            F.when(new, F.concat(acc["done"], before, F.lit("<secret>"))).otherwise(acc["done"]).alias("done"),
            F.greatest(acc["at"], x["end"]).alias("at"),
        )

    rest = lambda acc: F.concat(acc["done"], F.substring(body, acc["at"] + 1, F.length(body)))
    clean = F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(body)
    searched = find_secrets(df, text, found)
    return searched.select(*[clean.alias(c) if c == text else F.col(quoted(c)) for c in df.columns])
