"""Static data set cards (K9): a card as an object, rendered as Markdown with YAML front matter."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, FloatType, IntegerType, LongType, StringType, StructType

#: Names of column types in a card.
TYPES = {StringType: "string", IntegerType: "int32", LongType: "int64", DoubleType: "float64", FloatType: "float32", BooleanType: "bool"}


def type_name(kind: DataType) -> str:
    if isinstance(kind, ArrayType):
        return f"list[{type_name(kind.elementType)}]"
    return "struct" if isinstance(kind, StructType) else TYPES.get(type(kind), kind.simpleString())


@dataclass(frozen=True)
class Card:
    """What a card says. `columns` describes columns by name; columns of the schema that it does not name are listed
    without words. `sections` are further headings with their text, in order; `citation` is BibTeX or plain."""

    title: str
    summary: str
    languages: tuple[str, ...]
    tasks: tuple[str, ...]
    tags: tuple[str, ...] = ()
    license: str | None = None
    columns: dict[str, str] = field(default_factory=dict)
    sections: dict[str, str] = field(default_factory=dict)
    citation: str | None = None

    def front_matter(self) -> str:
        """YAML; values that are not plain words are quoted."""
        plain = lambda v: v if v.replace("-", "").replace("_", "").replace(".", "").isalnum() and not v.replace(".", "").isdigit() and v.lower() not in ("no", "yes", "on", "off", "true", "false", "null") else json.dumps(v, ensure_ascii=False)
        lists = (("language", self.languages), ("task_categories", self.tasks), ("tags", self.tags))
        out = [line for name, values in lists if values for line in (f"{name}:", *(f"- {plain(v)}" for v in values))]
        return "\n".join(["---", *out, *([f"license: {plain(self.license)}"] if self.license else []), "---"])

    def render(self, schema: StructType | None = None) -> str:
        parts = [self.front_matter(), f"# {self.title}", self.summary.strip()]
        if schema is not None:
            unknown = set(self.columns) - set(schema.names)
            if unknown:
                raise ValueError(f"described but not in the schema: {sorted(unknown)}")
            rows = [f"| `{f.name}` | `{type_name(f.dataType)}` | {self.columns.get(f.name, '')} |" for f in schema]
            parts += ["## Schema", "\n".join(["| Column | Type | Description |", "|---|---|---|", *rows])]
        for heading, text in self.sections.items():
            parts += [f"## {heading}", text.strip()]
        if self.citation:
            parts += ["## Citation", f"```\n{self.citation.strip()}\n```"]
        return "\n\n".join(parts) + "\n"
