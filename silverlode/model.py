"""Data model: the Bronze tables, the JSON arrays they carry, and the Silver tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import ArrayType, StringType, StructField, StructType


def struct(**columns: str) -> StructType:
    """A struct of nullable columns, in the order given."""
    out = StructType()
    for name, type_name in columns.items():
        out.add(name, type_name)
    return out


# --- Fixed values -----------------------------------------------------------------
# Column names, types and sentinels that results must agree on.

MOVIES_BRONZE = struct(
    budget="long",
    genres="string",
    homepage="string",
    id="long",
    keywords="string",
    original_language="string",
    original_title="string",
    overview="string",
    popularity="double",
    production_companies="string",
    production_countries="string",
    release_date="string",
    revenue="long",
    runtime="double",
    spoken_languages="string",
    status="string",
    tagline="string",
    title="string",
    vote_average="double",
    vote_count="long",
)

CREDITS_BRONZE = struct(movie_id="long", title="string", cast="string", crew="string")

BRONZE = {"movies": MOVIES_BRONZE, "credits": CREDITS_BRONZE}

CREW_ELEMENT = struct(
    department="string", credit_id="string", gender="integer", id="integer", name="string", job="string"
)
CAST_ELEMENT = struct(
    cast_id="integer",
    character="string",
    credit_id="string",
    gender="integer",
    id="integer",
    name="string",
    order="integer",
)
ID_NAME_ELEMENT = struct(id="integer", name="string")
COUNTRY_ELEMENT = struct(iso_3166_1="string", name="string")
LANGUAGE_ELEMENT = struct(iso_639_1="string", name="string")

NO_CREDIT_ID = "0000000000"
NO_ID = -9999
NO_CODE = "XX"

# Source column -> output column of the core movie table.
MOVIES_CORE = {
    "id": "movie_id",
    "title": "title",
    "budget": "budget",
    "homepage": "homepage",
    "original_language": "original_language",
    "original_title": "original_title",
    "overview": "overview",
    "popularity": "popularity",
    "release_date": "release_date",
    "revenue": "revenue",
    "runtime": "runtime",
    "status": "status",
    "tagline": "tagline",
    "vote_average": "vote_average",
    "vote_count": "vote_count",
}
# ----------------------------------------------------------------------------------


# Columns of rows that stand for a document that could not be read.
REJECTED, REASON, DOCUMENT = "rejected", "reason", "document"


@dataclass(frozen=True)
class JsonTable:
    """A relational table held as a JSON array of objects in one string column.

    ``parents`` maps source columns to the names they carry in the result, ``element`` is the
    declared type of one array element, ``fields`` are the element fields kept, in output order,
    and ``fill`` gives the value that replaces a null in a field.
    """

    name: str
    source: str
    column: str
    element: StructType
    parents: dict[str, str]
    fields: tuple[str, ...]
    fill: dict[str, str | int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        outputs = [*self.parents.values(), *self.fields]
        if len(set(outputs)) != len(outputs):
            raise ValueError(f"{self.name}: output columns repeat: {outputs}")
        unknown = [f for f in self.fields if f not in self.element.names]
        if unknown:
            raise ValueError(f"{self.name}: fields not in the element type: {unknown}")
        unfillable = [f for f in self.fill if f not in outputs]
        if unfillable:
            raise ValueError(f"{self.name}: fill names no output column: {unfillable}")

    @property
    def parse_type(self) -> ArrayType:
        """What to parse: the kept fields only, so that dropped ones cost nothing."""
        return ArrayType(StructType([f for f in self.element if f.name in self.fields]))

    def reject_schema(self, source: StructType) -> StructType:
        """Of the documents that cannot be read: parent columns, why, and the text."""
        parents = [StructField(out, source[name].dataType) for name, out in self.parents.items()]
        return StructType([*parents, StructField(REASON, StringType()), StructField(DOCUMENT, StringType())])

    def output_schema(self, source: StructType) -> StructType:
        parents = [StructField(out, source[name].dataType) for name, out in self.parents.items()]
        return StructType(parents + [self.element[name] for name in self.fields])


_CREDIT_PARENTS = {"movie_id": "movie_id", "title": "title"}
_MOVIE_PARENTS = {"id": "movie_id"}

JSON_TABLES: dict[str, JsonTable] = {
    t.name: t
    for t in (
        JsonTable(
            "crew", "credits", "crew", CREW_ELEMENT, _CREDIT_PARENTS,
            ("id", "name", "department", "job", "credit_id"), {"credit_id": NO_CREDIT_ID},
        ),
        JsonTable(
            "cast", "credits", "cast", CAST_ELEMENT, _CREDIT_PARENTS,
            ("cast_id", "character", "credit_id", "gender", "id", "name"), {"credit_id": NO_CREDIT_ID},
        ),
        JsonTable(
            "genre", "movies", "genres", ID_NAME_ELEMENT, _MOVIE_PARENTS, ("id", "name"), {"id": NO_ID},
        ),
        JsonTable(
            "keywords", "movies", "keywords", ID_NAME_ELEMENT, _MOVIE_PARENTS, ("id", "name"), {"id": NO_ID},
        ),
        JsonTable(
            "production_companies", "movies", "production_companies", ID_NAME_ELEMENT, _MOVIE_PARENTS,
            ("id", "name"), {"id": NO_ID},
        ),
        JsonTable(
            "production_countries", "movies", "production_countries", COUNTRY_ELEMENT, _MOVIE_PARENTS,
            ("iso_3166_1", "name"), {"iso_3166_1": NO_CODE},
        ),
        JsonTable(
            "spoken_languages", "movies", "spoken_languages", LANGUAGE_ELEMENT, _MOVIE_PARENTS,
            ("iso_639_1", "name"), {"iso_639_1": NO_CODE},
        ),
    )
}

MOVIES_SILVER = StructType([StructField(out, MOVIES_BRONZE[name].dataType) for name, out in MOVIES_CORE.items()])


def check_schema(actual: StructType, declared: StructType, what: str) -> None:
    """Raise unless ``actual`` has the declared columns, in order, with the declared types."""
    found = [(f.name, f.dataType.simpleString()) for f in actual]
    wanted = [(f.name, f.dataType.simpleString()) for f in declared]
    if found != wanted:
        raise ValueError(f"{what}: found columns {found}, declared {wanted}")
