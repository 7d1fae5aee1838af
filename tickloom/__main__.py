import sys

from tickloom.cli import main

sys.exit(main())
