"""Reading what may not be there yet.

Only a missing path means "nothing stored". Any other read error is raised:
a state that cannot be read must never look like an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException


def if_present(read: Callable):
    """What ``read`` returns, or None if its path does not exist."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
