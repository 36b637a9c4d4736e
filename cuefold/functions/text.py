"""Text expressions: ordered rewrite rules, transcript checks, buckets, lexicons and prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuefold.columns import free
from cuefold.functions.replacements import replace_chain  # noqa: F401

# The normaliser's phrases and rules, (label, pattern, replacement) in order.
SALAWAT = "صَلَّى اللَّهُ عَلَيْهِ وَسَلَّمَ"
ALAYHISSALAM = "عَلَیْہِ السَّلَام"
RADIALLAHU = "رَضِیَ اللَّهُ عَنْہُ"
RULES = (
    ("U+FDFA", "ﷺ", f" {SALAWAT} "),
    ("U+0610", "ؐ", f" {SALAWAT} "),
    ("U+0611", "ؑ", f" {ALAYHISSALAM} "),
    ("U+0613", "ؓ", f" {RADIALLAHU} "),
    ("U+200C", "‌", ""),
    ("space before full stop", " +۔", "۔"),
    ("no space after comma", r"(?U)،(\S)", "، $1"),
)
# Punctuation that word error rates ignore, and the ends of sentences and clauses.
WER_PUNCTUATION = "[۔،؛؟!?.,:;\"'“”‘’()\\-—…]"
SENTENCE_END = r"(?U)[۔؟!]\s*$"
CLAUSE_END = r"(?U)،\s*$"
LATIN_RUN = "[A-Za-z]{2,}"
# The sentence that opens a prompt.
CARRIER = "آج کی گفتگو روحانیت اور تصوف کے بارے میں ہے۔"

SPACE = r"[\s\x1c-\x1f]"
#: White space of all scripts, as str.strip knows it.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))


def strip(text: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.btrim(text, F.lit(SPACES))


def _literal(pattern: str) -> bool:
    return not set(pattern) & set("\\^$.|?*+()[]{}")


#: Of rules that are no literals: what a text must hold for them to fire, and the bytes that each firing adds, if always as many.
PROBES = {" +۔": (" ۔", None), r"(?U)،(\S)": ("،", 1)}


def _rewritten(text: Column, pattern: str, replacement: str) -> Column:
    """A rule's result. Literals need no regular expression, and only texts that hold what a rule needs are rewritten."""
    if _literal(pattern):
        return F.replace(text, F.lit(pattern), F.lit(replacement))
    after = F.regexp_replace(text, F.lit(pattern), F.lit(replacement))
    return F.when(F.contains(text, F.lit(PROBES.get(pattern, ("", None))[0])), after).otherwise(text)


def _fired(before: Column, after: Column, pattern: str, replacement: str) -> Column:
    """How often a rule fired: where each firing adds as many bytes, the lengths tell."""
    grows = len(replacement.encode()) - len(pattern.encode()) if _literal(pattern) else PROBES.get(pattern, ("", None))[1]
    if grows:
        n = ((F.octet_length(after) - F.octet_length(before)) / F.lit(grows)).cast("int")
    else:
        n = F.when(before != after, F.regexp_count(before, F.lit(pattern)))
    return F.coalesce(n, F.lit(0))


def _single_spaced(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("  ")), F.regexp_replace(text, "  +", " ")).otherwise(text)


def normalise(df: DataFrame, text_col: str = "transcript", rules=RULES) -> DataFrame:
    """df with `hits` (a count for each rule), `changed`, and the text rewritten where a rule fired.

    Each rule sees the result of the one before. Runs of spaces collapse last. A text that no rule
    touches stays as it is, spaces too; null stays null. Columns of those names in df raise.

    The results pass an explode of one element: Spark pushes a later filter below columns, and as each step reads the one
    before more than once, it would compute the first of them a hundred times in the filter alone."""
    free(df, "hits", "changed", "_row", *[f"_{x}{k}" for x in "nt" for k in range(len(rules))])
    out, at, counts = df, text_col, []
    for k, (_, pattern, replacement) in enumerate(rules):  # one column for each step, so that none is computed twice
        out = out.withColumn(f"_t{k}", _rewritten(F.col(at), pattern, replacement))
        counts.append(_fired(F.col(at), F.col(f"_t{k}"), pattern, replacement))
        at = f"_t{k}"
    out = out.withColumns({f"_n{k}": n for k, n in enumerate(counts)})
    counts = [F.col(f"_n{k}") for k in range(len(rules))]
    fired = F.greatest(*counts, F.lit(0), F.lit(0)) > 0
    out = out.withColumn("changed", fired)
    text = F.when(F.col("changed"), strip(_single_spaced(F.col(at)))).otherwise(F.col(text_col))
    row = F.struct(F.array(*counts).alias("hits"), F.col("changed"), text.alias("text"))
    out = out.select("*", F.explode(F.array(row)).alias("_row")).drop("changed", *[f"_{x}{k}" for x in "nt" for k in range(len(rules))])
    return out.withColumn("hits", F.col("_row.hits")).withColumn("changed", F.col("_row.changed")).withColumn(text_col, F.col("_row.text")).drop("_row")


def rule_totals(normalised: DataFrame, rules=RULES) -> DataFrame:
    """label, n, rows: how often each rule that fired did, and in how many rows."""
    labels = F.array(*[F.lit(r[0]) for r in rules])
    hits = normalised.select(F.explode(F.arrays_zip(labels.alias("label"), F.col("hits").alias("n"))).alias("h")).where("h.n > 0")
    return hits.groupBy(F.col("h.label").alias("label")).agg(F.sum("h.n").alias("n"), F.count("*").alias("rows"))


def changed_log(before: DataFrame, pos_col: str = "pos", text_col: str = "transcript", rules=RULES) -> DataFrame:
    """pos, rules, before, after of the rows that normalise changes."""
    rows = normalise(before.withColumn("before", F.col(text_col)), text_col, rules).where("changed")
    fired = F.concat(*[F.when(F.col("hits")[i] > 0, F.array(F.format_string(f"{r[0]} x%d", F.col("hits")[i]))).otherwise(F.array().cast("array<string>")) for i, r in enumerate(rules)])
    return rows.select(pos_col, fired.alias("rules"), "before", F.col(text_col).alias("after"))


def valid_transcript(text: Column) -> Column:
    """Two characters at least once stripped, 500 at most as it is; null is not valid."""
    return F.coalesce((F.length(strip(text)) >= 2) & (F.length(text) <= 500), F.lit(False))


def ends_sentence(text: Column) -> Column:
    return strip(text).rlike(SENTENCE_END)


def ends_clause(text: Column) -> Column:
    return strip(text).rlike(CLAUSE_END)


def ending(text: Column) -> Column:
    return F.when(ends_sentence(text), "sentence").when(ends_clause(text), "clause").otherwise("hard")


def wer_text(text: Column) -> Column:
    """Punctuation becomes a space, white space one space; diacritics and case stay."""
    return strip(F.regexp_replace(F.regexp_replace(text, WER_PUNCTUATION, " "), f"(?U){SPACE}+", " "))


def correct_ci(text: Column, corrections: dict[str, str]) -> Column:
    """Substrings replaced whatever their case, in order."""
    for wrong, right in corrections.items():
        text = F.regexp_replace(text, F.lit("(?iu)" + "".join("\\" + c if not c.isalnum() and c != " " else c for c in wrong)), F.lit(right.replace("\\", "\\\\").replace("$", "\\$")))
    return text


def buckets(text: Column, terms: list[str], latin: str = LATIN_RUN) -> Column:
    """code_switch or nastaliq_only; then spiritual_term where a term is a substring."""
    held = F.exists(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(text, t)) if terms else F.lit(False)
    first = F.when(text.rlike(latin), "code_switch").otherwise("nastaliq_only")
    return F.array_compact(F.array(first, F.when(held, F.lit("spiritual_term"))))


def prompt(groups: list[tuple[Column, str, str]], carrier: str = CARRIER, most: int = 20) -> Column:
    """The carrier sentence, then each group's first `most` terms joined and ended; empty groups are left out."""
    parts = [F.when(F.size(terms) > 0, F.concat(F.array_join(F.slice(terms, 1, most), by), F.lit(end))) for terms, by, end in groups]
    return F.concat_ws(" ", F.lit(carrier), *parts)


def codepoints(df: DataFrame, text_col: str) -> DataFrame:
    """codepoint, n of all characters."""
    chars = df.select(F.explode(F.split(text_col, "")).alias("ch")).where("ch <> ''")
    return chars.groupBy("ch").agg(F.count("*").alias("n")).select(F.ascii("ch").cast("long").alias("codepoint"), "n")


def chunks_to_text(chunks: Column) -> Column:
    """Each chunk's text stripped, one a line."""
    return F.array_join(F.transform(chunks, lambda c: strip(c["text"])), "\n")


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """part of whole as text, 12.3%; of nothing, 0.0%."""
    return F.format_string(f"%.{digits}f%%", F.when(whole > 0, 100 * part / whole).otherwise(F.lit(0.0)).cast("double"))


def hours(seconds: Column, digits: int = 2) -> Column:
    """Seconds as text in hours, 1.25h; null is none."""
    return F.format_string(f"%.{digits}fh", (F.coalesce(seconds, F.lit(0.0)) / 3600).cast("double"))


def profile(rows: DataFrame, group: str, text_col: str = "transcript", duration_col: str = "duration") -> DataFrame:
    """group, rows, missing, empty, too_long, seconds: what a manifest holds by group, and which texts are null, blank or not valid for length."""
    text = F.col(text_col)
    return rows.groupBy(group).agg(
        F.count("*").alias("rows"), F.count_if(text.isNull()).alias("missing"), F.count_if(strip(text) == "").alias("empty"),
        F.count_if(F.length(text) > 500).alias("too_long"), F.sum(duration_col).alias("seconds"),
    )
