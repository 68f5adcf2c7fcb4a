from relweave.cli import main

main()
