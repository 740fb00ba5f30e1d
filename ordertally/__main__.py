import sys

from ordertally.cli import main

sys.exit(main())
