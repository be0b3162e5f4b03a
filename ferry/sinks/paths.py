"""Output paths: name tokens and Azure addresses."""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import date
from urllib.parse import unquote, urlsplit

# Endings by format.
EXTENSIONS = {"arrow": ".arrow", "csv": ".csv", "jsonl": ".jsonl", "parquet": ".parquet"}

_TOKEN = re.compile(r"\{\{\s*([^{}]*?)\s*\}\}")
_BLOB_HOST = ".blob.core.windows.net"


def extension(fmt: str, compression: str) -> str:
    """`.csv`, `.csv.gz`, `.snappy.arrow`."""
    ending = EXTENSIONS.get(fmt.lower(), "")
    if compression.lower() == "gzip":
        return ending + ".gz"
    if compression.lower() == "snappy":
        return ".snappy" + ending
    return ending


def token_values(
    stream_name: str, fmt: str, compression: str, today: date | None = None, variables: Mapping[str, str] | None = None
) -> dict[str, str]:
    """What the tokens stand for: the day, facts of the move, and `.NAME` for every variable."""
    today = today or date.today()
    return {
        "YYYY": f"{today:%Y}",
        "MM": f"{today:%m}",
        "DD": f"{today:%d}",
        "stream_name": stream_name,
        "format": fmt,
        "compression": compression,
        "ext": extension(fmt, compression),
    } | {f".{k}": v for k, v in (variables or {}).items()}


def render_name(
    template: str, stream_name: str, fmt: str, compression: str, today: date | None = None, variables: Mapping[str, str] | None = None
) -> str:
    return render_tokens(template, token_values(stream_name, fmt, compression, today, variables))


def render_tokens(template: str, values: Mapping[str, str]) -> str:
    """Plain substitution, once: tokens in what is put in stay as they are."""

    def one(m: re.Match) -> str:
        if m[1] not in values:
            raise ValueError(f"unknown token {m[0]} in {template!r}")
        return values[m[1]]

    return _TOKEN.sub(one, template)


def output_path(base: str, filename: str) -> str:
    """Destination URL and file name joined; an empty name is an error."""
    if not filename or not filename.strip():
        raise ValueError("filename must not be empty")
    head, mark, query = base.partition("?")
    return head.rstrip("/") + "/" + filename.lstrip("/") + mark + query


def hadoop_path(url: str) -> tuple[str, dict[str, str]]:
    """Path that Spark writes to and the options that carry its credentials.

    `azure://account/container/...` and `https://account.blob.core.windows.net/container/...`, with
    a SAS token in the password or the query, become `abfss://`; `azurite://` becomes the emulator's
    `wasb://`. Everything else passes unchanged.
    """
    parts = urlsplit(url)
    if parts.scheme not in ("azure", "https", "azurite"):
        return url, {}
    host = parts.hostname or ""
    if parts.scheme == "https" and not host.endswith(_BLOB_HOST):
        raise ValueError(f"not an Azure Blob address: {host}")
    pieces = [p for p in parts.path.split("/") if p]
    token = unquote(parts.password) if parts.password else parts.query
    if parts.scheme == "azurite":
        account, *pieces = pieces or [""]
    else:
        account = host.removesuffix(_BLOB_HOST)
    if not account or len(pieces) < 2:
        raise ValueError("an Azure address needs an account, a container and a name")
    container, rest = pieces[0], "/".join(pieces[1:])
    if parts.scheme == "azurite":
        options = {"fs.azure.storage.emulator.account.name": f"{account}{_BLOB_HOST}"}
        if token:
            options[f"fs.azure.sas.{container}.{account}{_BLOB_HOST}"] = token
        return f"wasb://{container}@{account}{_BLOB_HOST}/{rest}", options
    endpoint = f"{account}.dfs.core.windows.net"
    options = {}
    if token:
        options = {f"fs.azure.account.auth.type.{endpoint}": "SAS", f"fs.azure.sas.fixed.token.{endpoint}": token}
    return f"abfss://{container}@{endpoint}/{rest}", options
