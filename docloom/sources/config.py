"""Source configurations: a closed schema, read from YAML, checked on the driver."""

from __future__ import annotations

import posixpath
import re
from dataclasses import dataclass, field, fields
from urllib.parse import unquote, urlsplit

#: Kinds of regulatory documents and accepted quality routes (fixed values).
DOCUMENT_TYPES = ["法律法规", "政策文件", "标准规范", "通知公告", "行政处罚", "司法文书", "统计数据", "企业信息", "其他"]
ROUTES = ["accept", "accept_ocr", "accept_with_warning"]


class ConfigError(ValueError):
    """A refused configuration; the message is a code."""


def _range(value, low, high, code: str):
    if isinstance(value, bool) or not isinstance(value, (int, float)) or not low <= value <= high:
        raise ConfigError(code)
    return value


def _pattern(value: str) -> str:
    try:
        re.compile(value)
    except (re.error, TypeError):
        raise ConfigError("invalid_regex") from None
    return value


def _closed(kind, values: dict):
    """A dataclass from a mapping; unknown keys are refused."""
    if not isinstance(values, dict) or set(values) - {f.name for f in fields(kind)}:
        raise ConfigError("unknown_config_key")
    return kind(**values)


@dataclass
class Budget:
    requests: int = 100
    seconds: int = 120
    response_bytes: int = 10_485_760
    documents: int = 10_000

    def __post_init__(self):
        _range(self.requests, 1, 100_000, "invalid_budget")
        _range(self.seconds, 1, 86_400, "invalid_budget")
        _range(self.response_bytes, 1024, 134_217_728, "invalid_budget")
        _range(self.documents, 1, 1_000_000, "invalid_budget")


@dataclass
class FieldRule:
    """A constant, or a pattern on a page's text, with a date form."""

    value: str | None = None
    regex: str | None = None
    date_format: str | None = None

    def __post_init__(self):
        if (self.value is None) == (self.regex is None):
            raise ConfigError("field_rule_needs_one_source")
        if self.regex is not None:
            _pattern(self.regex)


@dataclass
class SourceConfig:
    id: str
    entry_urls: list[str]
    allowed_hosts: list[str]
    scope: str
    archive_approved: bool
    allowed_path_prefixes: list[str] = field(default_factory=lambda: ["/"])
    host_path_scopes: dict[str, list[str]] = field(default_factory=dict)
    detail_url_patterns: list[str] = field(default_factory=list)
    blocked_patterns: list[str] = field(default_factory=list)
    fields: dict = field(default_factory=dict)
    budget: dict = field(default_factory=dict)
    document_type: str = "其他"
    accepted_routes: list[str] = field(default_factory=lambda: list(ROUTES))
    recheck_seconds: int = 86_400
    robots: bool = True

    def __post_init__(self):
        if not re.fullmatch(r"dd-[0-9]{3,}", self.id or ""):
            raise ConfigError("invalid_source_id")
        if self.archive_approved is not True:
            raise ConfigError("source_archive_approval_required")
        if not self.entry_urls or not self.allowed_hosts:
            raise ConfigError("empty_source")
        if self.document_type not in DOCUMENT_TYPES:
            raise ConfigError("invalid_document_type")
        if set(self.accepted_routes) - set(ROUTES) or len(set(self.accepted_routes)) != len(self.accepted_routes):
            raise ConfigError("invalid_quality_route")
        _range(self.recheck_seconds, 0, 31_536_000, "invalid_recheck")
        self.entry_urls = list(dict.fromkeys(self.entry_urls))
        for p in [*self.detail_url_patterns, *self.blocked_patterns]:
            _pattern(p)
        for p in [*self.allowed_path_prefixes, *(x for some in self.host_path_scopes.values() for x in some)]:
            if not p.startswith("/") or ".." in p or unquote(p) != p or set(p) & set("?#\\"):
                raise ConfigError("invalid_path_scope")
        if self.host_path_scopes and (set(self.host_path_scopes) != set(self.allowed_hosts) or not all(self.host_path_scopes.values())):
            raise ConfigError("invalid_host_path_scope")
        self.budget = _closed(Budget, self.budget) if isinstance(self.budget, dict) else self.budget
        self.fields = {k: _closed(FieldRule, v) if isinstance(v, dict) else v for k, v in self.fields.items()}
        for url in self.entry_urls:
            parts = urlsplit(url)
            if parts.scheme not in ("http", "https") or not self.in_scope(parts.hostname or "", parts.path):
                raise ConfigError("source_out_of_scope")

    def in_scope(self, host: str, path: str) -> bool:
        prefixes = self.host_path_scopes.get(host, []) if self.host_path_scopes else self.allowed_path_prefixes
        path = posixpath.normpath(unquote(path or "/"))
        return host in self.allowed_hosts and any(path == p.rstrip("/") or path.startswith(p.rstrip("/") + "/") for p in prefixes)


def parse(values: dict) -> SourceConfig:
    """A configuration from a mapping."""
    try:
        return _closed(SourceConfig, values)
    except TypeError:
        raise ConfigError("missing_config_key") from None


def load(path: str) -> SourceConfig:
    """A configuration from a YAML file; a key that comes twice is refused."""
    import yaml

    class Loader(yaml.SafeLoader):
        pass

    def mapping(loader, node, deep=False):
        keys = [loader.construct_object(k, deep=deep) for k, _ in node.value]
        if len(set(keys)) != len(keys):
            raise ConfigError("duplicate_config_key")
        return {k: loader.construct_object(v, deep=True) for k, (_, v) in zip(keys, node.value)}

    Loader.add_constructor(yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, mapping)
    with open(path, encoding="utf-8") as f:
        values = yaml.load(f, Loader=Loader)  # noqa: S506  a safe loader
    if not isinstance(values, dict):
        raise ConfigError("invalid_source_config")
    return parse(values)


def page_arguments(limit: int, after: str = "") -> None:
    """The bounds of a page request."""
    if isinstance(limit, bool) or not isinstance(limit, int) or not 1 <= limit <= 100 or len(after) > 1000:
        raise ConfigError("invalid_arguments")
