"""chatscope: Spark jobs for preparing and scoring tool-calling chat data.

Every public operator takes and returns DataFrames; nothing is collected
to the driver. See README.md for the module map.
"""

__version__ = "0.1.0"
