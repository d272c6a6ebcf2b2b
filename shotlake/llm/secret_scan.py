"""Secret scans: patterns and sliding-window entropy, in native expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shotlake.llm.expressions import let, running

# The base patterns. `value` is the group whose length counts, 0 the whole match.
BASE = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]
#: Kinds that are one maximal run, and the code points of it before the repeated class: the length is asked of the
#: pattern itself, which then finds the same runs and not each short one.
WHOLE_RUNS = {"access": 4, "hex": 0}

#: Code points of a window, and by character class: candidate strings, alphabet (after folding), bits wanted.
WINDOW = 20
#: Counts of five bits in a whole number of 64.
PACKED = 12
CLASSES = [
    ("entropy_hex", r"[0-9A-Fa-f]{20,}", "0123456789abcdef", True, 3.0),
    ("entropy_base64", r"[A-Za-z0-9+/_=-]{20,}", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", False, 3.9),
]
#: Candidates that are no secrets: without digits, without letters, UUIDs, one class inside the other, placeholders.
ALLOWED = [
    r"^[^0-9]*$",
    r"^[^A-Za-z]*$",
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"(?i)example|sample|dummy|placeholder|changeme|xxxx|0123456789|abcdefghij",
]
#: The one of them that isn't about a whole run: it speaks for the piece between / and = that holds it.
PLACEHOLDER = ALLOWED[-1]
KINDS = [k for k, *_ in BASE] + [k for k, *_ in CLASSES]
SPAN = "array<struct<start:bigint,rank:int,kind:string,end:bigint>>"


def _matches(text: Column, pattern: str, value: int = 0, least: int = 0) -> Column:
    """Leftmost non-overlapping matches whose group `value` (0: the whole) has at least `least` code points, as
    array<struct<start, end, found>>, in code points. The work is linear in the text but for the running sum of the
    matches' lengths (n log n in their number)."""

    def over(found: Column) -> Column:
        def placed(gaps: Column) -> Column:
            sizes = F.transform(found, lambda f, i: (F.length(F.get(gaps, i)) + F.length(f)).cast("long"))
            return let(running(sizes, lambda a, b: a + b), lambda ends: F.transform(found, lambda f, i: F.struct((F.get(ends, i) - F.length(f)).alias("start"), F.get(ends, i).alias("end"), f.alias("found"))))

        places = let(F.split(text, pattern, -1), placed)
        if not value:
            return F.filter(places, lambda m: F.length(m["found"]) >= least)
        return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(value)), lambda values: F.filter(places, lambda m, i: F.length(F.get(values, i)) >= least))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), over)


def _spans(text: Column, kind: str, pattern: str, value: int, least: int) -> Column:
    rank = F.lit(KINDS.index(kind))
    if kind in WHOLE_RUNS:
        pattern = pattern[:-1] + f"{{{least - WHOLE_RUNS[kind]},}}"
    return F.transform(_matches(text, pattern, value, least), lambda m: F.struct(m["start"].alias("start"), rank.alias("rank"), F.lit(kind).alias("kind"), m["end"].alias("end")))


def _dense(found: Column, alphabet: str, fold: bool, bits: float) -> Column:
    """struct<first, last>: where the windows of found with at least `bits` of entropy begin and end; null if none.

    One pass moves the window on by a character: two counts change, and with them the sum of c * log2(c), from
    which the entropy is log2(WINDOW) - sum / WINDOW. Counts are kept five bits each in a few whole numbers, so that
    a step costs the same whatever the alphabet.
    """
    term = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)])
    # a character's code: the number that holds its count above bit 6, the count's place there below
    table = F.array(*[F.lit(64 * (k // PACKED) + 5 * (k % PACKED)) for k in range(len(alphabet))])
    codes = F.transform(F.split(F.lower(found) if fold else found, ""), lambda c: F.get(table, F.instr(F.lit(alphabet), c) - 1))
    words = [f"w{k}" for k in range(-(-len(alphabet) // PACKED))]
    begin = F.struct(*[F.lit(0).cast("long").alias(w) for w in words], F.lit(0.0).alias("sum"), F.lit(0).alias("i"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))
    one = F.lit(1).cast("long")

    def count(s: Column, code: Column) -> Column:
        held = s[words[-1]]
        for k in range(len(words) - 2, -1, -1):
            held = F.when(F.shiftright(code, 6) == k, s[words[k]]).otherwise(held)
        return F.call_function("shiftright", held, code.bitwiseAND(F.lit(63))).bitwiseAND(F.lit(31)).cast("int")

    def over(codes: Column) -> Column:
        def step(s: Column, c: Column) -> Column:
            i = s["i"]
            out = F.when(i >= WINDOW, F.get(codes, i - WINDOW)).otherwise(F.lit(-1))

            def moved(o: Column) -> Column:
                n_in = count(s, c)
                plus = F.get(term, n_in + 1) - F.get(term, n_in)
                n_out = count(s, o) + F.when(o == c, 1).otherwise(0)
                minus = F.when(o < 0, F.lit(0.0)).otherwise(F.get(term, n_out) - F.get(term, n_out - 1))
                total = s["sum"] + plus - minus
                of = lambda code: F.call_function("shiftleft", one, code.bitwiseAND(F.lit(63)))
                zero = F.lit(0).cast("long")
                counts = [s[w] + F.when(F.shiftright(c, 6) == k, of(c)).otherwise(zero) - F.when((o >= 0) & (F.shiftright(o, 6) == k), of(o)).otherwise(zero) for k, w in enumerate(words)]
                high = (i >= WINDOW - 1) & (math.log2(WINDOW) - total / WINDOW >= bits)
                first = F.when(high & (s["first"] < 0), i - (WINDOW - 1)).otherwise(s["first"])
                last = F.when(high, i + 1).otherwise(s["last"])
                return F.struct(*[x.alias(w) for x, w in zip(counts, words)], total.alias("sum"), (i + 1).alias("i"), first.alias("first"), last.alias("last"))

            return let(out, moved)

        return F.aggregate(codes, begin, step)

    return let(codes, over)


def _without_placeholders(found: Column) -> Column:
    """found with each piece between / and = that holds a placeholder replaced by as many hyphens."""
    pieces = F.transform(F.split(found, "(?<=[/=])"), lambda p: F.when(p.rlike(PLACEHOLDER), F.repeat(F.lit("-"), F.length(p))).otherwise(p))
    return F.when(found.rlike(PLACEHOLDER), F.array_join(pieces, "")).otherwise(found)


def _entropy(text: Column, kind: str, pattern: str, alphabet: str, fold: bool, bits: float) -> Column:
    rank = F.lit(KINDS.index(kind))

    def fine(m: Column) -> Column:
        allowed = F.lit(False)
        for a in ALLOWED[:-1]:
            allowed = allowed | m["rest"].rlike(a)
        if not fold:
            allowed = allowed | m["found"].rlike("^[0-9A-Fa-f]*$")
        return ~allowed

    runs = F.transform(_matches(text, pattern), lambda m: F.struct(m["start"].alias("start"), m["found"].alias("found"), _without_placeholders(m["found"]).alias("rest")))
    tried = F.transform(F.filter(runs, fine), lambda m: F.struct(m["start"].alias("start"), _dense(m["rest"], alphabet, fold, bits).alias("dense")))
    dense = F.filter(tried, lambda m: m["dense"]["first"] >= 0)
    return F.transform(dense, lambda m: F.struct((m["start"] + m["dense"]["first"]).alias("start"), rank.alias("rank"), F.lit(kind).alias("kind"), (m["start"] + m["dense"]["last"]).alias("end")))


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(record, spans): every row of docs as the struct record, and its spans as
    array<struct<start, rank, kind, end>> by start, then kind; code points, end exclusive.

    Base spans are the matches of BASE. Added to them are runs of the CLASSES' characters in which a sliding
    window reaches the class's entropy, unless an ALLOWED pattern says that the run is harmless or a base span
    covers it. A placeholder excuses only the piece between / and = that holds it. A null or empty text has no spans. Rows are neither moved nor merged; the columns keep their
    names inside record.
    """
    record = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("record")
    text = F.coalesce(docs[text_col], F.lit(""))
    none = F.array().cast(SPAN)

    def when_found(pattern: str, spans: Column) -> Column:
        return F.when(text.rlike(pattern), spans).otherwise(none).cast(SPAN)

    quick = {"assign": r"(?i:password|passwd|secret|token|api_?key)[\x20\"':=]", "access": r"AKIA[A-Z0-9]{16}", "hex": r"[0-9a-f]{24}"}
    base = F.concat(*[when_found(quick[k], _spans(text, k, p, v, n)) for k, p, v, n in BASE])
    more = F.concat(*[when_found(p, _entropy(text, k, p, *rest)) for k, p, *rest in CLASSES])

    def uncovered(spans: Column) -> Column:
        far = running(F.transform(spans, lambda s: F.when(s["rank"] < len(BASE), s["end"]).otherwise(F.lit(0).cast("long"))), F.greatest)
        return let(far, lambda f: F.filter(spans, lambda s, i: (s["rank"] < len(BASE)) | (F.get(f, i) < s["end"])))

    return docs.select(record, let(F.array_sort(F.concat(base, more)), uncovered).alias("spans"))


def written(spans: Column, kinds: list[str] | None = None) -> Column:
    """kind:start:end of the spans (of the given kinds), joined by commas."""
    if kinds:
        spans = F.filter(spans, lambda s: s["kind"].isin(kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", n_chars_col: str = "n_chars") -> DataFrame:
    """docs with each run of overlapping spans replaced by mark, and n_chars_col, if there, counted anew for the
    texts that changed. Texts without spans stay as they are; no row goes."""
    found = scan(docs, text_col)
    text, spans = F.col(f"record.{text_col}"), F.col("spans")

    def marked(blocks: Column, reach: Column) -> Column:
        def part(a: Column, b: Column) -> Column:
            # from the blocks it lies in: a substring of the text would be counted off from its start each time
            first, last = F.shiftright(a, 10), F.shiftright(b - 1, 10)
            near = F.array_join(F.slice(blocks, (first + 1).cast("int"), (last - first + 1).cast("int")), "")
            return F.when(b > a, F.substring(near, (a.bitwiseAND(F.lit(1023)) + 1).cast("int"), (b - a).cast("int"))).otherwise("")

        before = lambda i: F.coalesce(F.get(reach, i - 1), F.lit(0).cast("long"))
        kept = F.filter(F.transform(spans, lambda s, i: F.struct(before(i).alias("a"), s["start"].alias("b"))), lambda p: p["b"] >= p["a"])
        pieces = F.transform(kept, lambda p: F.concat(part(p["a"], p["b"]), F.lit(mark)))
        return F.concat(F.array_join(pieces, ""), part(F.array_max(reach), F.length(text).cast("long")))

    blocks = F.regexp_extract_all(text, F.lit("(?s).{1,1024}"), F.lit(0))
    clean = let(blocks, lambda b: let(running(F.transform(spans, lambda s: s["end"]), F.greatest), lambda r: marked(b, r)))
    found = found.select("record", F.when(F.size(spans) > 0, clean).alias("clean"))
    columns = []
    for c in docs.columns:
        old = F.col(f"record.`{c}`")
        if c == text_col:
            old = F.coalesce("clean", old)
        elif c == n_chars_col:
            old = F.when(F.col("clean").isNotNull(), F.length("clean").cast(docs.schema[c].dataType)).otherwise(old)
        columns.append(old.alias(c))
    return found.select(*columns)
