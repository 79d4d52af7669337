"""Column builders for text: event features, name signatures, lineup keys, dates and labels."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The event grammar. Substrings that raise a flag, and patterns whose first group is a feature.
EVENT_FLAGS = {
    "is_fastbreak": "fastbreak",
    "is_from_turnover": "fromturnover",
    "is_paint": "pointsinthepaint",
    "is_second_chance": "2ndchance",
    "is_shooting_foul": "shooting;",
    "is_looseball_foul": "looseball",
    "is_one_and_one": "oneandone",
    "is_flagrant": "flagrant",
}
EVENT_EXTRACTS = {
    "assist_player": (r" - ([^,]+), assist", "string"),
    "ft_number": (r"(?U)freethrow (\d)of\d", "bigint"),
    "ft_attempts": (r"(?U)freethrow \dof(\d)", "bigint"),
    "foul_class": (r"foul (personal|offensive|technical|adminTechnical)", "string"),
    "foul_tech_class": (r"(benchclassb|coachclassb|classa|classb|administrative|contactdeadball)", "string"),
    "ft_awarded": (r"(?U)(\d)freethrow", "bigint"),
    "turnover_type": (r"(?U)turnover (\w+)", "string"),
    "timeout_type": (r"(?U)timeout (\w+)", "string"),
    "challenge_outcome": (r"(?U)headcoachchallenge \w+ (accepted|rejected)", "string"),
}
#: Name suffixes that no signature keeps.
NAME_SUFFIXES = ["jr", "sr", "ii", "iii", "iv", "v"]
#: Those that hold no other: a name without any of them has no suffix.
SHORTEST_SUFFIXES = [s for s in NAME_SUFFIXES if not any(o in s for o in NAME_SUFFIXES if o != s)]
#: The ASCII characters that are no letter or digit.
NO_LETTERS = "".join(c for c in map(chr, range(0x80)) if not c.isalnum())


def extract(text: Column | str, pattern: str, kind: str = "string") -> Column:
    """The pattern's first group as ``kind``; null where it does not match, or is no number."""
    found = F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    return found if kind == "string" else found.try_cast(kind)


def has(text: Column | str, needle: str) -> Column:
    """Whether the text holds the needle; false for null."""
    return F.coalesce(F.contains(text, F.lit(needle)), F.lit(False))


def event_features(events: DataFrame, column: str = "event_description") -> DataFrame:
    """Add the eighteen event features; unchanged if there is no description column."""
    if column not in events.columns:
        return events
    d = F.col(column)
    made = {name: has(d, needle) for name, needle in EVENT_FLAGS.items()}
    made |= {name: extract(d, pattern, kind) for name, (pattern, kind) in EVENT_EXTRACTS.items()}
    made["is_team_turnover"] = has(d, "turnover") & has(d, " team;")
    return events.withColumns(made)


def decompositions(keep) -> tuple[str, str, dict[str, str]]:
    """By rule, from Unicode's compatibility decompositions: (characters, what each becomes, those that become several).

    ``keep`` tells which characters of a decomposition stay. Characters that become nothing
    or stay as they are, are left out, and so are Hangul syllables, which only come apart.
    """
    ones, became, several = [], [], {}
    for c in map(chr, (*range(0x80, 0xAC00), *range(0xD7A4, 0xD800), *range(0xE000, 0x30000))):
        whole = unicodedata.normalize("NFKD", c)
        if whole != c and (out := "".join(x for x in whole if keep(x))):
            if len(out) == 1:
                ones.append(c)
                became.append(out)
            else:
                several[c] = out
    return "".join(ones), "".join(became), several


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def in_ones(text: Column, table: tuple[str, str, dict[str, str]]) -> Column:
    """The text with those of the table's characters replaced that become one; one that is all ASCII is left as it is."""
    return F.when(is_ascii(text), text).otherwise(F.translate(text, *table[:2]))


def in_several(text: Column, table: tuple[str, str, dict[str, str]]) -> Column:
    """The text with those of the table's characters replaced that become several; one that is all ASCII is left as it is."""
    names = F.create_map(*[F.lit(x) for pair in table[2].items() for x in pair])
    each = F.array_join(F.transform(F.split(text, ""), lambda c: F.when(c < "\x80", c).otherwise(F.coalesce(F.try_element_at(names, c), c))), "")
    return F.when(is_ascii(text), text).otherwise(each)


def decomposed(text: Column, table: tuple[str, str, dict[str, str]]) -> Column:
    """The text with the table's characters replaced."""
    return in_several(in_ones(text, table), table)


TO_ASCII = decompositions(str.isascii)


def only_ascii(text: Column) -> Column:
    """The rest of ``ascii_fold`` for a text of which ``in_ones`` was taken."""
    return F.lower(F.when(is_ascii(text), text).otherwise(F.regexp_replace(in_several(text, TO_ASCII), "[^\\x00-\\x7F]+", "")))


def ascii_fold(text: Column) -> Column:
    """Compatibility decomposition without what is not ASCII, in lower case."""
    return only_ascii(in_ones(text, TO_ASCII))


def signature_of_folded(folded: Column) -> Column:
    """Letters of a folded name in order: no suffixes, apostrophes, word order or format survive."""
    # A suffix that is a word of its own goes, and all that is no letter or digit.
    firsts = "".join(sorted({s[0] for s in NAME_SUFFIXES}))
    bare = F.regexp_replace(folded, rf"(?=[{firsts}])(?<![a-z0-9'])(?:{'|'.join(NAME_SUFFIXES)})(?![a-z0-9'])", "")
    # Most names hold none, which is told faster than by the pattern.
    suffixed = reduce(lambda a, b: a | b, [F.contains(folded, F.lit(s)) for s in SHORTEST_SUFFIXES])
    joined = F.translate(F.when(suffixed, bare).otherwise(folded), NO_LETTERS, "")
    return F.array_join(F.sort_array(F.split(joined, "")), "")


def signature(name: Column) -> Column:
    """What forms of one name have in common, null for null; built-in functions only."""
    return signature_of_folded(ascii_fold(name))


def name_signatures(names: DataFrame, column: str = "name") -> DataFrame:
    """(name, signature) for distinct names."""
    distinct = names.select(F.col(column).alias("name")).where(F.col("name").isNotNull()).distinct()
    return distinct.withColumn("signature", signature(F.col("name")))


def case_folded(text: Column) -> Column:
    """Full case folding: what differs in case alone becomes equal, so that ß is ss."""
    # By way of upper case, which has one form for all; a dotless i has none, and a sigma at the end of a word two lower ones.
    upper = F.translate(F.upper(F.translate(text, "ı", "\ue000")), "Σ", "\ue001")
    return F.translate(F.lower(upper), "\ue000\ue001", "ıσ")


def team_norm(team: Column) -> Column:
    """White space collapsed, trimmed, case folded."""
    return case_folded(F.trim(F.regexp_replace(team, r"(?U)\s+", " ")))


def lineup_key(team: Column, players: Column) -> Column:
    """Sixteen hex digits that identify a team's set of players; null without team or players."""
    # In steps of their own, as what is used several times in a lambda is also made several times.
    folded = F.transform(F.transform(players, lambda n: in_ones(n, TO_ASCII)), only_ascii)
    signatures = F.sort_array(F.transform(folded, signature_of_folded))
    body = F.concat(team_norm(team), F.lit("|"), F.array_join(signatures, "|"))
    # Team and players are not null here, and neither is the key. Saying so lets joins test keys for null without making them.
    key = F.coalesce(F.substring(F.md5(body.cast("binary")), 1, 16), F.lit(""))
    return F.when((F.size(players) > 0) & (team != ""), key)


def add_lineup_keys(df: DataFrame, sides: dict[str, tuple[str, str]]) -> DataFrame:
    """Add a lineup key per entry: its name, and the columns of the team and of the array of players' names."""
    return df.withColumns({out: lineup_key(F.col(team), F.col(players)) for out, (team, players) in sides.items()})


def season_label(season: int) -> str:
    """2025 as ``2024-25``."""
    return f"{season - 1}-{season % 100:02d}"


def lenient_date(text: Column | str) -> Column:
    """MM/DD/YYYY as a date; null for anything else."""
    return F.try_to_date(text, "MM/dd/yyyy")


#: An option element with a numeric value, whatever its other attributes, quotes and case: groups 2 and 3 are value and text.
OPTION = r"(?i)<option\b[^>]*?\svalue\s*=\s*([\"']?)([0-9]+)\1(?=[\s/>])[^>]*>\s*([^<]*[^<\s])\s*</option\b"

def all_groups(page: Column, pattern: str, groups: dict[str, int]) -> Column:
    """Every match of the pattern in page order, as structs of the named groups."""
    return F.arrays_zip(*[F.regexp_extract_all(page, F.lit(pattern), F.lit(i)).alias(name) for name, i in groups.items()])


def option_pairs(page: Column) -> Column:
    """All (pid, name) of option elements with a numeric value."""
    return all_groups(page, OPTION, {"pid": 2, "name": 3})


def human_size(n: float) -> str:
    """Bytes in the largest unit up to GB that leaves at least one."""
    for unit in ("B", "KB", "MB"):
        if n < 1024:
            return f"{n:.1f} {unit}" if unit != "B" else f"{int(n)} B"
        n /= 1024
    return f"{n:.1f} GB"
