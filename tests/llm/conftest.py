"""Brute-force helpers of the operators' tests are shared with the pipeline's."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
