"""Texts and values for readers: safe values of tags, briefs of a consensus, citation records of a dataset, costs of a run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# fixed values: wording of a brief
NONE_FLAGGED = "- Pathology: none flagged by consensus"
HEADS = {"structures": "- Coverage: ", "differential": "  - Differential: ", "notable": "- Notable: ", "disputed": "- ⚠ Inter-model disagreement on: "}


def safe_value(value: Column, kind: Column, most: int = 64) -> Column:
    """A tag's value as text by kind (bytes, sequence, or any other): bytes up to `most` as hex, longer ones and sequences by their size.

    value: the raw bytes; of a sequence, its number of items as text in bytes. Null stays null.
    """
    n = F.octet_length(value)
    raw = F.when(n <= most, F.lower(F.hex(value))).otherwise(F.concat(F.lit("[bytes: "), n.cast("string"), F.lit("]")))
    text = F.decode(value, "UTF-8")
    return F.when(kind == "bytes", raw).when(kind == "sequence", F.concat(F.lit("[Sequence: "), text, F.lit(" items]"))).otherwise(text)


def split_value(value: Column, numeric: Column) -> Column:
    """The parts of a value with several, separated by a backslash, as JSON: numbers where `numeric` and all of them are some, else texts."""
    parts = F.split(value, r"\\")
    numbers = F.transform(parts, lambda p: p.try_cast("double"))
    whole = F.coalesce(numeric, F.lit(False)) & F.forall(numbers, lambda n: n.isNotNull() & ~F.isnan(n))
    return F.when(whole, F.to_json(numbers)).otherwise(F.to_json(parts))


def disagreement_records(field: list[tuple[str, Column, Column]]) -> Column:
    """An array of (field, votes) for each (field, whether it is disputed, votes as a map of value to count); undisputed fields are left out."""
    rows = [F.when(F.coalesce(disputed, F.lit(False)), F.struct(F.lit(name).alias("field"), votes.alias("votes"))) for name, disputed, votes in field]
    return F.array_compact(F.array(*rows))


def brief(label: Column, error: Column, sequence: Column, agreement: Column, grade: Column, structures: Column, found: Column, agreeing: Column, total: Column, findings: Column, differential: Column, notable: Column, disputed: Column) -> Column:
    """A series' consensus as a short text of lines. Lists are arrays of texts; what is null or empty has no line.

    At most 12 structures, 6 findings, 5 differentials and 6 notes are named, as it is a brief; with an error it is all there is.
    """
    some = lambda c, most: F.slice(F.coalesce(c, F.array().cast("array<string>")), 1, most)
    listed = lambda head, c, most, sep: F.when(F.size(some(c, most)) > 0, F.concat(F.lit(head), F.array_join(some(c, most), sep)))
    seen = F.coalesce(found, F.lit(False))
    count = lambda c: F.coalesce(c, F.lit(0)).cast("string")
    head = F.concat(F.lit("- **Pathology** ("), count(agreeing), F.lit("/"), count(total), F.lit(" models):"))
    told = F.when(F.size(some(findings, 6)) > 0, F.array_join(F.transform(some(findings, 6), lambda f: F.concat(F.lit("  - "), f)), "\n"))
    percent = F.concat(F.bround(F.coalesce(agreement, F.lit(0.0)) * 100).cast("long").cast("string"), F.lit("%"))
    lines = F.concat_ws(
        "\n",
        F.concat(F.lit("- Sequence: **"), F.coalesce(sequence, F.lit("?")), F.lit("** (agreement "), percent, F.lit(")")),
        F.concat(F.lit("- Quality grade: **"), F.coalesce(grade, F.lit("?")), F.lit("**")),
        listed(HEADS["structures"], structures, 12, ", "),
        F.when(seen, head).otherwise(NONE_FLAGGED),
        F.when(seen, told),
        F.when(seen, listed(HEADS["differential"], differential, 5, "; ")),
        listed(HEADS["notable"], notable, 6, "; "),
        F.when(F.size(disputed) > 0, F.concat(F.lit(HEADS["disputed"]), F.array_join(disputed, ", "))),
    )
    return F.concat(F.lit("### "), F.coalesce(label, F.lit("?")), F.lit("\n"), F.when(error.isNotNull(), F.concat(F.lit("_"), error, F.lit("_"))).otherwise(lines))


def citation(title: Column, creators: Column, publisher: Column, year: Column, doi: Column, subjects: Column, abstract: Column, start: Column, end: Column, sizes: Column, version: Column) -> Column:
    """A dataset's citation record (schema kernel-4) as a struct for to_json: six mandatory parts, subjects, abstract, collection dates."""
    one = lambda **fields: F.struct(*[v.alias(k) for k, v in fields.items()])
    return one(
        identifiers=F.array(one(identifier=F.concat(F.lit("https://doi.org/"), doi), identifierType=F.lit("DOI"))),
        creators=F.transform(creators, lambda c: one(name=c, nameType=F.lit("Personal"))),
        titles=F.array(one(title=title, titleType=F.lit("Main"))),
        publisher=publisher,
        publicationYear=year.cast("string"),
        types=one(resourceTypeGeneral=F.lit("Dataset")),
        subjects=F.transform(subjects, lambda s: one(subject=s)),
        descriptions=F.array(one(description=abstract, descriptionType=F.lit("Abstract"))),
        dates=F.array(one(date=F.concat_ws("/", start, end), dateType=F.lit("Collected"))),
        sizes=sizes,
        version=version,
        schemaVersion=F.lit("http://datacite.org/schema/kernel-4"),
    )


def citation_gaps(record: Column) -> Column:
    """The mandatory parts that a citation record lacks: null, an empty text or list, or first values that are null."""
    lacks = {
        "identifiers": record["identifiers"][0]["identifier"].isNull(),
        "creators": F.coalesce(F.size(record["creators"]), F.lit(0)) < 1,
        "titles": F.coalesce(F.trim(record["titles"][0]["title"]), F.lit("")) == "",
        "publisher": F.coalesce(F.trim(record["publisher"]), F.lit("")) == "",
        "publicationYear": ~F.coalesce(record["publicationYear"].rlike("^[0-9]{4}$"), F.lit(False)),
        "subjects": F.coalesce(F.size(record["subjects"]), F.lit(0)) < 1,
        "descriptions": F.coalesce(F.trim(record["descriptions"][0]["description"]), F.lit("")) == "",
    }
    return F.array_compact(F.array(*[F.when(gone, F.lit(name)) for name, gone in lacks.items()]))


def cost_line(label: str, compute: Column, calls: Column) -> Column:
    """`label: compute=$.. calls=$.. total=$..` with four places; what is unknown is n/a, and so is the total if both are."""
    money = lambda v: F.coalesce(F.concat(F.lit("$"), F.format_string("%.4f", v)), F.lit("n/a"))
    known = F.when(compute.isNull() & calls.isNull(), F.lit(None)).otherwise(F.coalesce(compute, F.lit(0.0)) + F.coalesce(calls, F.lit(0.0)))
    shown = lambda v: F.when(v.isNull(), "n/a").otherwise(money(v))
    return F.concat(F.lit(f"{label}: compute="), shown(compute), F.lit(" calls="), shown(calls), F.lit(" total="), shown(known))
