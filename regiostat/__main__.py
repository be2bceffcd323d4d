import sys

from regiostat.cli import main

main(sys.argv[1:])
