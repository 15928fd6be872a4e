"""The driver's log: a rotating file and the console."""

from __future__ import annotations

import logging
import os
from logging.handlers import RotatingFileHandler

FILE_BYTES, FILES = 5 * 1024 * 1024, 5


def setup_logging(folder: str, name: str = "corpusloom", level: int = logging.INFO) -> logging.Logger:
    """Handlers of the library's logger, once however often it is called."""
    logger = logging.getLogger(name)
    logger.setLevel(level)
    if not any(isinstance(h, RotatingFileHandler) for h in logger.handlers):
        os.makedirs(folder, exist_ok=True)
        form = logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s")
        for handler in (RotatingFileHandler(os.path.join(folder, f"{name}.log"), maxBytes=FILE_BYTES, backupCount=FILES, encoding="utf-8"), logging.StreamHandler()):
            handler.setFormatter(form)
            logger.addHandler(handler)
    return logger
