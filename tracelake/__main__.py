import sys

from tracelake.cli import main

sys.exit(main())
