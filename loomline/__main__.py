import sys

from loomline.cli import main

sys.exit(main())
