"""Log lines as text or JSON, each with the fields of its run."""

from __future__ import annotations

import json
import logging
from datetime import UTC, datetime


class Lines(logging.Formatter):
    def __init__(self, form: str = "text", **context: str) -> None:
        super().__init__()
        if form not in ("text", "json"):
            raise ValueError("log lines are text or json")
        self.form, self.context = form, {k: v for k, v in context.items() if v}

    def format(self, record: logging.LogRecord) -> str:
        fields = {"time": datetime.fromtimestamp(record.created, UTC).isoformat(), "level": record.levelname, "logger": record.name, "message": record.getMessage(), **self.context, **getattr(record, "fields", {})}
        if record.exc_info:
            fields["error"] = self.formatException(record.exc_info)
        if self.form == "json":
            return json.dumps(fields, ensure_ascii=False, default=str)
        head = [fields.pop(n) for n in ("time", "level", "logger", "message")]
        return " ".join([*head, *[f"{k}={v}" for k, v in fields.items()]])


def configure(level: str = "INFO", form: str = "text", **context: str) -> logging.Logger:
    """The package's logger, with one handler however often this is called."""
    logger = logging.getLogger("tidemark")
    logger.handlers.clear()
    handler = logging.StreamHandler()
    handler.setFormatter(Lines(form, **context))
    logger.addHandler(handler)
    logger.setLevel(level.upper())
    logger.propagate = False
    return logger
