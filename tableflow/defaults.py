"""Defaults shared by the operators.

Fixed values (behaviour users of the original helpers rely on):

* timestamp text pattern for declared-schema casts: ``dd/MM/yyyy``
* label of rows no condition matches: ``NA``
* amount pattern and stripped characters: ``RM (.+)`` (group 1), ``,``
* column family of cell tables: ``cf``
* line length limit of a spool reader: 2048 characters; raised limit of the
  long-line flow: 4600 characters
* idle time after which a text sink closes its file: 5 seconds
* flow option names in section-style configs: ``spoolDir``, ``HDFSDir``,
  ``inputCharset``, ``maxLineLength``
"""

DEFAULT_TIME_FORMAT = "dd/MM/yyyy"
DEFAULT_NA = "NA"
DEFAULT_AMOUNT_PATTERN = "RM (.+)"
DEFAULT_AMOUNT_GROUP = 1
DEFAULT_AMOUNT_STRIP = ","
DEFAULT_FAMILY = "cf"
DEFAULT_MAX_LINE_LENGTH = 2048
LONG_LINE_LENGTH = 4600
DEFAULT_IDLE_SECONDS = 5
FLOW_KEY_SPOOL_DIR = "spoolDir"
FLOW_KEY_SINK_DIR = "HDFSDir"
FLOW_KEY_CHARSET = "inputCharset"
FLOW_KEY_MAX_LINE = "maxLineLength"
