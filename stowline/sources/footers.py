"""Schemas and row counts from Parquet footers."""

import json
from dataclasses import dataclass, field

import pyarrow.parquet as pq
from pyspark.sql import SparkSession

from stowline.sources.storage import locate

# The type each stored type is shown as; text is the only
# annotation that changes it.
TARGET_TYPES = {
    "int64": "INT64",
    "int32": "INT32",
    "boolean": "BOOLEAN",
    "binary": "BYTES",
    "float": "FLOAT32",
    "double": "FLOAT64",
    "int96": "BYTES",
    "fixed_len_byte_array": "BYTES",
}

@dataclass
class Field:
    """One node of a Parquet schema; a group has children and no physical type."""

    name: str
    repetition: str
    physical: str | None
    logical: str | None
    children: list = field(default_factory=list)

    @property
    def repeated(self) -> bool:
        return self.repetition == "repeated"

    @property
    def annotation(self) -> str:
        return (self.logical or "").split("(")[0]

    @property
    def target(self) -> str:
        if self.physical is None:
            shown = "STRUCT"
        elif self.physical == "binary" and self.annotation == "String":
            shown = "STRING"
        else:
            shown = TARGET_TYPES[self.physical]
        return f"ARRAY<{shown}>" if self.repeated else shown

    def walk(self, path=()):
        for child in self.children:
            yield (*path, child.name), child
            yield from child.walk((*path, child.name))


def open_footer(uri: str) -> pq.ParquetFile:
    system, path = locate(uri)
    return pq.ParquetFile(system.open_input_file(path))


# How annotations of groups are shown.
_GROUPS = {"LIST": "List", "MAP": "Map", "MAP_KEY_VALUE": "Map"}


def read_kind(uri: str) -> tuple[str, int]:
    """A text that only files of one schema share, and the rows of the file; for use in tasks."""
    with open_footer(uri) as file:
        schema = file.schema
        # the first line names an object in memory
        tree = str(schema).partition("\n")[2]
        return json.dumps([tree, [schema.column(i).path for i in range(len(schema))]]), file.metadata.num_rows


def read_message(spark: SparkSession, uri: str) -> Field:
    """The schema tree of a file, as Spark's own Parquet reader has it; for use on the driver.

    Leaves have the annotation that Arrow shows, which is the same for older and newer files.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.parquet.hadoop
    reader = hadoop.ParquetFileReader.open(
        hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(uri), conf)
    )
    try:
        message = reader.getFileMetaData().getSchema()
    finally:
        reader.close()
    with open_footer(uri) as file:
        columns = iter([str(file.schema.column(i).logical_type) for i in range(len(file.schema))])

    def node(found) -> Field:
        name, repetition = found.getName(), found.getRepetition().name().lower()
        if found.isPrimitive():
            logical = next(columns)
            physical = found.asPrimitiveType().getPrimitiveTypeName().name().lower()
            return Field(name, repetition, physical, None if logical == "None" else logical)
        annotation = found.getLogicalTypeAnnotation()
        logical = annotation and _GROUPS.get(annotation.toString())
        return Field(name, repetition, None, logical, [node(f) for f in found.asGroupType().getFields()])

    return Field(message.getName(), "required", None, None, [node(f) for f in message.getFields()])


def from_json(node: dict) -> Field:
    """A tree from what ``dataclasses.asdict`` made of it."""
    return Field(**{**node, "children": [from_json(c) for c in node["children"]]})


def merged(one: Field, other: Field, where: tuple[str, str], path: tuple = ()) -> Field:
    """A schema that holds the fields of both, by name; ``where`` names the files of each."""
    if (one.physical, one.logical, one.repeated) != (other.physical, other.logical, other.repeated):
        shown = [f"{f.repetition} {f.physical or 'group'} {f.logical or ''}".strip() for f in (one, other)]
        raise ValueError(f"column {'.'.join(path)} is {shown[0]} in {where[0]} and {shown[1]} in {where[1]}")
    rest = {c.name: c for c in other.children}
    children = [
        merged(c, rest.pop(c.name), where, (*path, c.name)) if c.name in rest else c for c in one.children
    ]
    strict = one.repetition == other.repetition
    return Field(
        one.name, one.repetition if strict else "optional", one.physical, one.logical, children + list(rest.values())
    )
