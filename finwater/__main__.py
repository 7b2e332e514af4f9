import sys

from finwater.cli import main

main(sys.argv[1:])
