"""What the user declares: the table, its keys, and how a run behaves."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, fields, replace

from pyspark.sql import types as T

# The words that mean "true", shared by option parsing and by
# boolean coercion of table values.
TRUE_WORDS = ("1", "t", "true", "y", "yes", "on")

# Column names with this prefix are used while joining and are refused in tables.
RESERVED_PREFIX = "__"
# In ``order_by``: the place of a row in the files it is read from.
SCAN_ORDER = "__scan"

DUPLICATE_POLICIES = ("last", "first", "error")
UNIQUE_CHECKS = ("final", "strict")


def check_identifier(name: str) -> str:
    """Accept a non-empty name of letters, digits and underscores only."""
    if not name or any(not (ch.isalnum() or ch == "_") for ch in name):
        raise ValueError(f"not a valid identifier: {name!r}")
    return name


def safe_name(name: str) -> str:
    """A name without the characters that mean something inside a column path."""
    return name.replace("%", "%25").replace(".", "%2E").replace("`", "%60")


def plain_name(name: str) -> str:
    return name.replace("%60", "`").replace("%2E", ".").replace("%25", "%")


def text_is_true(text: str | None, default: bool = False) -> bool:
    return default if text is None else text.strip().lower() in TRUE_WORDS


def _tuple(names: Iterable[str] | str) -> tuple[str, ...]:
    return (names,) if isinstance(names, str) else tuple(names)


@dataclass(frozen=True)
class Reference:
    """Columns of a table that name a row of a parent table, or are NULL."""

    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]

    def __post_init__(self) -> None:
        object.__setattr__(self, "columns", _tuple(self.columns))
        object.__setattr__(self, "parent_columns", _tuple(self.parent_columns))
        if not self.columns or len(self.columns) != len(self.parent_columns):
            raise ValueError(f"a reference to {self.parent} needs as many columns on either side")

    def safe(self) -> Reference:
        return replace(
            self,
            columns=map(safe_name, self.columns),
            parent_columns=map(safe_name, self.parent_columns),
        )


@dataclass(frozen=True)
class TableSpec:
    """A keyed table.

    ``key`` is the primary key in key order. ``unique_keys`` lists further unique
    constraints of the target (Spark cannot discover them). ``identity`` names key
    columns fed by an allocator, ``declared_types`` holds the declared type text
    of source columns, and ``order_by`` is the order in which source rows count as
    applied when several rows share a key. Rows it does not tell apart count in the order
    they are read, where that is known; ``SCAN_ORDER`` names that order itself.
    ``references`` name parent tables; rows a run writes must have a parent there.
    """

    name: str
    key: tuple[str, ...]
    unique_keys: tuple[tuple[str, ...], ...] = ()
    identity: tuple[str, ...] = ()
    declared_types: Mapping[str, str] = field(default_factory=dict)
    order_by: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()

    def __post_init__(self) -> None:
        check_identifier(self.name)
        object.__setattr__(self, "key", _tuple(self.key))
        object.__setattr__(self, "unique_keys", tuple(_tuple(k) for k in self.unique_keys))
        object.__setattr__(self, "identity", _tuple(self.identity))
        object.__setattr__(self, "order_by", _tuple(self.order_by))
        object.__setattr__(self, "references", tuple(self.references))
        if not self.key:
            raise ValueError(f"table {self.name} has no primary key")
        outside = [c for c in self.identity if c not in self.key]
        if outside:
            raise ValueError(f"identity columns must belong to the key: {outside}")

    def safe(self) -> TableSpec:
        """The same table with safe column names."""
        return replace(
            self,
            key=map(safe_name, self.key),
            unique_keys=[map(safe_name, unique) for unique in self.unique_keys],
            identity=map(safe_name, self.identity),
            order_by=map(safe_name, self.order_by),
            references=[r.safe() for r in self.references],
            declared_types={safe_name(c): kind for c, kind in self.declared_types.items()},
        )

    def check_source(self, schema: T.StructType) -> None:
        """Fail before any job when the source cannot serve this table.

        Columns of unique keys may be missing: they keep their values, NULL in new rows.
        """
        check_columns(schema)
        wanted = [*self.key, *(c for c in self.order_by if c != SCAN_ORDER)]
        absent = sorted({c for c in wanted if c not in schema.names})
        if absent:
            raise ValueError(f"columns not in the source of {self.name}: {absent}")


def check_columns(schema: T.StructType) -> None:
    folded: dict[str, str] = {}
    for name in schema.names:
        if name.startswith(RESERVED_PREFIX):
            raise ValueError(f"column names starting with {RESERVED_PREFIX!r} are reserved: {name}")
        if name.lower() in folded:
            raise ValueError(f"columns differ only in case: {folded[name.lower()]}, {name}")
        folded[name.lower()] = name


@dataclass(frozen=True)
class SyncOptions:
    """How one run behaves. ``allow_prune`` is the policy gate of ``prune``."""

    incremental_col: str | None = None
    full_refresh: bool = False
    prune: bool = False
    allow_prune: bool = False
    insert_only: bool = False
    add_columns: bool = False
    dry_run: bool = False
    sync_sequence: bool = False
    on_duplicate: str = "last"
    unique_check: str = "final"
    source_key_is_unique: bool = False

    def __post_init__(self) -> None:
        if self.incremental_col is not None:
            check_identifier(self.incremental_col)
        if self.on_duplicate not in DUPLICATE_POLICIES:
            raise ValueError(f"on_duplicate must be one of {DUPLICATE_POLICIES}")
        if self.unique_check not in UNIQUE_CHECKS:
            raise ValueError(f"unique_check must be one of {UNIQUE_CHECKS}")

    @classmethod
    def from_flags(cls, flags: Mapping[str, object], settings: Mapping[str, str]) -> SyncOptions:
        """Join call flags with text settings: a switch is on when either turns it on.

        ``allow_prune`` is a policy, so only the settings can turn it on.
        """
        known = {f.name: f.type for f in fields(cls)}
        merged = {k: v for k, v in flags.items() if k in known and v is not None}
        for name in ("sync_sequence", "insert_only", "add_columns"):
            merged[name] = bool(merged.get(name)) or text_is_true(settings.get(name))
        merged["allow_prune"] = text_is_true(settings.get("allow_prune"))
        return cls(**merged)

    def check_prune(self) -> None:
        if self.prune and not self.allow_prune:
            raise PermissionError("prune is switched off by policy (allow_prune is false)")
