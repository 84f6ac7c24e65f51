from sigflow.apps import main

main()
