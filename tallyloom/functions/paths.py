"""Reading dotted paths out of documents, typed or untyped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Paths:
    """Path access for one document column.

    The column is either a VARIANT (structure not checked yet) or a struct. A
    path that does not exist, or does not have the asked shape, reads as NULL.
    """

    def __init__(self, docs: DataFrame, column: str = "doc"):
        field = docs.schema[column]
        self.column = column
        self.variant = isinstance(field.dataType, T.VariantType)
        self._type = field.dataType

    def _exists(self, path: str) -> bool:
        node = self._type
        for part in path.split("."):
            if isinstance(node, T.ArrayType):
                node = node.elementType
            if not isinstance(node, T.StructType) or part not in node.names:
                return False
            node = node[part].dataType
        return True

    def is_list(self, path: str) -> bool:
        node = self._type
        for part in path.split("."):
            if not isinstance(node, T.StructType) or part not in node.names:
                return False
            node = node[part].dataType
        return isinstance(node, T.ArrayType)

    def raw(self, path: str) -> Column:
        if self.variant:
            return F.try_variant_get(F.col(self.column), f"$.{path}", "variant")
        if not self._exists(path):
            return F.lit(None)
        out = F.col(self.column)
        for part in path.split("."):
            out = out.getField(part)
        return out

    def text(self, path: str) -> Column:
        if self.variant:
            return F.try_variant_get(F.col(self.column), f"$.{path}", "string")
        return self.raw(path).cast("string")

    def whole(self, path: str) -> Column:
        """A whole number; text, fractions and flags read as NULL."""
        if not self.variant:
            return self.raw(path).try_cast("bigint")
        node = self.raw(path)
        return F.when(F.schema_of_variant(node) == "BIGINT",
                      F.try_variant_get(node, "$", "bigint"))

    def items(self, path: str) -> Column:
        """A list of elements."""
        if self.variant:
            return F.try_variant_get(F.col(self.column), f"$.{path}", "array<variant>")
        return self.raw(path)

    def texts(self, path: str) -> Column:
        if self.variant:
            return F.try_variant_get(F.col(self.column), f"$.{path}", "array<string>")
        return self.raw(path).cast("array<string>") if self._exists(path) else F.lit(None).cast("array<string>")

    def keys(self, path: str = "") -> Column:
        """The names inside an object of an untyped document."""
        where = f"$.{path}" if path else "$"
        return F.map_keys(F.try_variant_get(F.col(self.column), where, "map<string,variant>"))

    def inside(self, element: Column, path: str) -> Column:
        """Text at a path below one element of a list."""
        if self.variant:
            return F.try_variant_get(element, f"$.{path}", "string")
        out = element
        for part in path.split("."):
            out = out.getField(part)
        return out.cast("string")
