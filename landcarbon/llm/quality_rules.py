"""Quality rules: a table of thresholds becomes one projection of built-in functions.

Every measure is a ratio of counts of the whole text. A text without words fails; a null text counts as empty.
Repeated rows are judged one by one, and columns other than the id and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from landcarbon.llm.common import WHITE

# Frequent words of English, German, French and Spanish.
STOP_WORDS = (
    "the be to of and that have with is in it for on as by this was or from at "
    "der die das und zu von ist nicht mit ein eine auf für im den sich auch "
    "le la les de des et un une que est dans pour qui sur par du au "
    "el los las y en una se no por con para su es al"
).split()

# (rule, measure, least, most); a text passes where least <= measure <= most.
RULES = (
    ("word_length", "word_chars / n_words", 2.0, 15.0),
    ("symbols", "n_symbols / n_words", None, 0.30),
    ("stop_words", "n_stop / n_words", 0.02, None),
    ("capitals", "n_upper / word_chars", None, 0.50),
    ("repeated_lines", "n_dup_lines / n_lines", None, 0.50),
    ("cut_lines", "n_cut_lines / n_lines", None, 0.50),
    ("bullet_lines", "n_bullets / n_lines", None, 0.90),
)

# The counts, over w (words) and l (lines with a word).
_STOP = ", ".join(f"'{s}'" for s in sorted(set(STOP_WORDS)))
_WINDOWS = """sort_array(transform(sequence(0, size(w) - 3),
    i -> named_struct('k', concat_ws(' ', w[i], w[i + 1], w[i + 2]), 'i', i)))"""
_TWICE = """get(transform(array(zip_with(s, slice(s, 2, size(s)), (a, b) -> coalesce(a.k = b.k, false))), e ->
    sort_array(array_distinct(concat(
        filter(zip_with(s, e, (a, same) -> if(same, a.i, -1)), x -> x >= 0),
        filter(zip_with(slice(s, 2, size(s)), e, (b, same) -> if(same, b.i, -1)), x -> x >= 0))))), 0)"""
_REPEATED = f"""if(size(w) < 3, 0L, aggregate(get(transform(array({_WINDOWS}), s -> {_TWICE}), 0),
    named_struct('e', 0, 't', 0L),
    (acc, p) -> named_struct('e', p + 3, 't', acc.t + 3 - greatest(0, acc.e - p)), acc -> acc.t))"""
_COUNTS = f"""named_struct(
    'n_words', cast(size(w) as long),
    'word_chars', cast(length(array_join(w, '')) as long),
    'n_symbols', cast(regexp_count(txt, r'[#*$%&|<>]') as long),
    'n_upper', cast(regexp_count(txt, '[A-Z]') as long),
    'n_stop', cast(size(filter(w, x -> lower(x) in ({_STOP}))) as long),
    'n_lines', cast(size(l) as long),
    'n_dup_lines', cast(size(l) - size(array_distinct(l)) as long),
    'n_cut_lines', cast(size(filter(l, x -> x rlike r'(\\.\\.\\.|…)[{WHITE}]*$')) as long),
    'n_bullets', cast(size(filter(l, x -> x rlike r'^[{WHITE}]*[-*•]')) as long),
    'n_repeat_words', {_REPEATED})"""

BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


def rule_sql(measure: str, least: float | None, most: float | None) -> str:
    """True where a text breaks the rule; a measure without a value breaks none."""
    over = ratio(measure)
    broken = [f"{over} < {least}D" if least is not None else "", f"{over} > {most}D" if most is not None else ""]
    return f"coalesce({' or '.join(b for b in broken if b)}, false)"


def ratio(measure: str) -> str:
    up, down = measure.split(" / ")
    return f"(cast({up} as double) / nullif({down}, 0))"


def quality(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, broken rules and verdict of every text: (doc_id, counts, base_failed, broken, kept)."""
    texts = docs.selectExpr(f"`{id_col}` as doc_id", f"coalesce(`{text_col}`, '') as txt")
    # A one-element transform binds words and lines once for all counts.
    counted = texts.selectExpr(
        "doc_id",
        f"get(transform(array(named_struct('w', regexp_extract_all(txt, r'[^{WHITE}]+', 0), "
        f"'l', filter(split(txt, '\\n'), x -> x rlike r'[^{WHITE}]'))), b -> "
        f"get(transform(array(b.w), w -> get(transform(array(b.l), l -> {_COUNTS}), 0)), 0)), 0) as c",
    ).select("doc_id", "c.*")
    broken = ", ".join(f"if({rule_sql(m, lo, hi)}, '{name}', null)" for name, m, lo, hi in rules)
    judged = counted.selectExpr("*", f"({BASE_FAILED}) as base_failed", f"array_compact(array({broken})) as broken")
    return judged.selectExpr("*", "not base_failed and size(broken) = 0 as kept")
