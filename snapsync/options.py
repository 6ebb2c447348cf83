"""Job options: what to copy, how to split it and where it goes."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from typing import Any

MIB = 1024 * 1024

# The defaults a job gets when an option is left out.
DEFAULT_BYTES_PER_SPLIT = 100 * MIB
DEFAULT_MIN_SPLIT_BYTES = 200 * MIB
DEFAULT_MAX_PARALLEL_WRITERS = 8
DEFAULT_MAX_ATTEMPTS = 1
MUTABLE_MARKER = "updated_at"

# The names of settings. Sections first, then what each key sets.
DATABASE_SECTION, DATASET_SECTION = "source-db", "gcp"
FILES_SECTION = "source-files"
TARGET_FILES_SECTION, TARGET_CATALOG_SECTION = "target-files", "target-catalog"
DATABASE_KEYS = ("url", "user", "password", "database")
DATASET_KEYS = ("project-id", "tempbucket-id", "dataset-id", "table-prefix")
SOURCE_OPTIONS = {
    "tables-whitelist": "whitelist",
    "tables-blacklist": "blacklist",
    "auto-parallelize": "auto_split",
    "min-split-bytes": "min_split_bytes",
    "max-splits": "max_splits",
    "split-by": "split_by",
    "mutable-marker": "marker",
}
SPLIT_MEGABYTES = "megabytes-per-partition"
TARGET_OPTIONS = {
    "create-if-absent": "create_if_absent",
    "overwrite-existing": "overwrite_existing",
}
JOB_OPTIONS = {
    "attempt-incremental-updates": "incremental",
    "attempt-delta-updates": "delta",
    "reconcile-ranges": "reconcile",
    "shared-upper-cut": "consistent",
    "incremental-lookback": "lookback",
    "max-parallel-writers": "max_parallel_writers",
    "max-retries": "max_attempts",
    "retry-wait-seconds": "retry_wait_seconds",
    "raise-on-failure": "raise_on_failure",
}
DECLARED_SCHEMAS = "declared-schemas"
# Further keys of the sections, and the fields that they set.
DATABASE_FIELDS = {
    "driver": "driver",
    "fetch-size": "fetchsize",
    "options": "options",
    "catalog": "catalog",
}
TARGET_FILES_FIELDS = {
    "table-prefix": "prefix",
    "verify": "verify",
    "keep-versions": "keep_versions",
    "max-parts": "max_parts",
    "tier-parts": "tier",
    "write-options": "write_options",
}
TARGET_CATALOG_FIELDS = {
    "table-prefix": "prefix",
    "format": "format",
    "write-options": "write_options",
}
CREDENTIALS_VARIABLE = "GOOGLE_APPLICATION_CREDENTIALS"


def _name_set(names) -> frozenset[str]:
    if isinstance(names, str):
        raise TypeError("table lists must be lists of names, not one string")
    return frozenset(n.lower() for n in names or ())


@dataclass(frozen=True)
class CopyOptions:
    """Options of one copy job. Table lists are compared case-insensitively."""

    whitelist: frozenset[str] = frozenset()
    blacklist: frozenset[str] = frozenset()
    auto_split: bool = True
    bytes_per_split: int = DEFAULT_BYTES_PER_SPLIT
    min_split_bytes: int = DEFAULT_MIN_SPLIT_BYTES
    # None: as many as the size asks for.
    max_splits: int | None = None
    # "range": equal-width key ranges. "rows": ranges of equal row counts, for keys
    # that are not spread evenly; costs one extra pass over the key column. "auto":
    # the former where keys are unique and dense, so that no range can be overfull.
    split_by: str = "auto"
    marker: str = MUTABLE_MARKER
    overwrite_existing: bool = True
    create_if_absent: bool = True
    max_parallel_writers: int = DEFAULT_MAX_PARALLEL_WRITERS
    max_attempts: int = DEFAULT_MAX_ATTEMPTS
    retry_wait_seconds: float = 0.0
    incremental: bool = False
    # Incremental copies re-read this many keys below the high-water mark, for
    # rows that were committed late.
    lookback: int = 0
    # Copy of mutable tables with a key only what their marker column says has changed.
    delta: bool = False
    # Compare tables with an integral key range by range, and copy what differs.
    reconcile: bool = False
    # Fix the greatest key of every table before the first is read: rows that are added
    # meanwhile are in no split of any table.
    consistent: bool = False
    raise_on_failure: bool = False

    def __post_init__(self):
        object.__setattr__(self, "whitelist", _name_set(self.whitelist))
        object.__setattr__(self, "blacklist", _name_set(self.blacklist))
        for name in ("bytes_per_split", "max_splits", "max_parallel_writers"):
            if getattr(self, name) is not None and getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1")
        for name in ("min_split_bytes", "lookback", "retry_wait_seconds"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} must not be negative")
        if self.split_by not in ("auto", "range", "rows"):
            raise ValueError("split_by must be 'auto', 'range' or 'rows'")
        # Zero or less means a single attempt, as one is always made.
        object.__setattr__(self, "max_attempts", max(1, self.max_attempts))

    def with_(self, **changes) -> "CopyOptions":
        return replace(self, **changes)


@dataclass(frozen=True)
class FileTarget:
    """Versioned Parquet snapshots under ``path``, one directory per table."""

    path: str
    prefix: str = ""
    # Superseded versions kept for readers that still use them.
    keep_versions: int = 2
    # With this many parts the next increment joins them all into a new version.
    max_parts: int = 50
    # The newest parts are merged as soon as so many are of one level.
    tier: int = 8
    # Compare the written files with the rows seen, by a digest, before they appear.
    verify: bool = False
    write_options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        for name, least in (("keep_versions", 1), ("max_parts", 1), ("tier", 2)):
            if getattr(self, name) < least:
                raise ValueError(f"{name} must be at least {least}")

    def qualified(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/{name}"


@dataclass(frozen=True)
class CatalogTarget:
    """Tables of one database of the session catalog."""

    database: str
    prefix: str = ""
    format: str = "parquet"
    write_options: Mapping[str, str] = field(default_factory=dict)

    def qualified(self, name: str) -> str:
        return f"{self.database}.{name}"


@dataclass(frozen=True)
class ConnectorTarget:
    """Tables written by an external connector, for example ``bigquery``.

    Option values may hold ``{table}``, which becomes the qualified name.
    """

    dataset: str
    project: str | None = None
    prefix: str = ""
    format: str = "bigquery"
    options: Mapping[str, str] = field(default_factory=dict, repr=False)

    def qualified(self, name: str) -> str:
        table = f"{self.dataset}.{name}" if self.dataset else name
        return f"{self.project}:{table}" if self.project else table

    def write_options(self, name: str, create: bool = True) -> dict[str, str]:
        table = self.qualified(name)
        filled = {k: str(v).replace("{table}", table) for k, v in self.options.items()}
        if self.format == "bigquery":
            filled.setdefault("table", table)
            if not create:
                filled.setdefault("createDisposition", "CREATE_NEVER")
        return filled


Target = FileTarget | CatalogTarget | ConnectorTarget


def _section(settings: Mapping[str, Any], name: str, required=()) -> Mapping[str, Any]:
    section = settings.get(name)
    if not isinstance(section, Mapping):
        raise ValueError(f"settings need a {name!r} section")
    for key in required:
        if section.get(key) is None:
            raise ValueError(f"settings need {name}.{key}")
    return section


def _known(section: Mapping[str, Any], where: str, *names) -> None:
    """Refuse settings that would be ignored."""
    unknown = sorted(set(section) - {n for group in names for n in group})
    if unknown:
        raise ValueError(f"unknown settings in {where}: {', '.join(unknown)}")


def _fields(section: Mapping[str, Any], names: Mapping[str, str]) -> dict[str, Any]:
    return {field: section[key] for key, field in names.items() if key in section}


def _source(settings: Mapping[str, Any]):
    """The source and the section it comes from."""
    from snapsync.sources.files import FileSource
    from snapsync.sources.jdbc import JdbcSource

    common = (SOURCE_OPTIONS, [SPLIT_MEGABYTES])
    if FILES_SECTION in settings:
        section = _section(settings, FILES_SECTION, ["path"])
        _known(section, FILES_SECTION, ["path", "keys"], *common)
        return FileSource(section["path"], keys=section.get("keys", {})), section
    section = _section(settings, DATABASE_SECTION, DATABASE_KEYS)
    _known(section, DATABASE_SECTION, DATABASE_KEYS, DATABASE_FIELDS, *common)
    chosen = {key: section[key] for key in DATABASE_KEYS}
    return JdbcSource(**chosen, **_fields(section, DATABASE_FIELDS)), section


def _target(settings: Mapping[str, Any], env: Mapping[str, str]):
    """The target and the section it comes from."""
    if TARGET_FILES_SECTION in settings:
        section = _section(settings, TARGET_FILES_SECTION, ["path"])
        _known(section, TARGET_FILES_SECTION, ["path"], TARGET_FILES_FIELDS, TARGET_OPTIONS)
        return FileTarget(section["path"], **_fields(section, TARGET_FILES_FIELDS)), section
    if TARGET_CATALOG_SECTION in settings:
        section = _section(settings, TARGET_CATALOG_SECTION, ["database"])
        _known(
            section, TARGET_CATALOG_SECTION, ["database"], TARGET_CATALOG_FIELDS, TARGET_OPTIONS
        )
        return CatalogTarget(section["database"], **_fields(section, TARGET_CATALOG_FIELDS)), section
    section = _section(settings, DATASET_SECTION, DATASET_KEYS)
    _known(section, DATASET_SECTION, DATASET_KEYS, TARGET_OPTIONS, ["write-options"])
    project, bucket, dataset, prefix = (section[key] for key in DATASET_KEYS)
    options = {"temporaryGcsBucket": bucket, "parentProject": project}
    if env.get(CREDENTIALS_VARIABLE):
        options["credentialsFile"] = env[CREDENTIALS_VARIABLE]
    options |= section.get("write-options", {})
    return ConnectorTarget(dataset, project, prefix=prefix, options=options), section


def load_settings(settings: Mapping[str, Any] | str, env: Mapping[str, str] | None = None):
    """Settings (a mapping or JSON text) -> ``(source, target, options)``.

    ``source-db`` names the database, ``gcp`` the warehouse dataset. Instead of
    these, ``source-files.path`` reads a directory of Parquet tables, and
    ``target-files.path`` or ``target-catalog.database`` writes to Spark's own
    storage.
    """
    if isinstance(settings, str):
        settings = json.loads(settings)
    sections = (
        DATABASE_SECTION, DATASET_SECTION, FILES_SECTION, TARGET_FILES_SECTION,
        TARGET_CATALOG_SECTION, DECLARED_SCHEMAS,
    )
    _known(settings, "the settings", sections, JOB_OPTIONS)
    source, source_section = _source(settings)
    target, target_section = _target(settings, os.environ if env is None else env)
    chosen = {
        name: section[key]
        for section, names in (
            (source_section, SOURCE_OPTIONS),
            (target_section, TARGET_OPTIONS),
            (settings, JOB_OPTIONS),
        )
        for key, name in names.items()
        if key in section
    }
    if SPLIT_MEGABYTES in source_section:
        chosen["bytes_per_split"] = source_section[SPLIT_MEGABYTES] * MIB
    return source, target, CopyOptions(**chosen)
